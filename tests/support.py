"""Values that several test modules share."""

from tollgate.config import SkewConfig

T0 = 1_767_225_600_000
SF = "/root/testdata/sf0.001"
# Every group with more than two rows is hot, so each hot path runs on small data.
HOT = SkewConfig(hot_rows=2, hot_share=0.0, block_rows=3, salts=4)
SKEWS = [SkewConfig(), HOT]
