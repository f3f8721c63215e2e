import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from tollgate.functions import ip, pan


@pytest.mark.parametrize(
    ("number", "expected"),
    [
        ("4111111111111111", ("411111", "1111", "411111******1111", None)),
        ("378282246310005", ("378282", "0005", "378282*****0005", None)),
        ("4111-1111 1111\t1111", ("411111", "1111", "411111******1111", None)),
        ("1234567890123456", "Luhn check failed"),
        ("41111111", "PAN length 8 is invalid (expected 15 or 16 digits)"),
        ("4111x11111111111", "PAN contains non-digit characters"),
        ("", "PAN contains non-digit characters"),
    ],
)
def test_card_numbers(spark, number, expected):
    digits = F.col("digits")
    row = (
        spark.createDataFrame([(number,)], "pan string")
        .select(pan.normalise(F.col("pan")).alias("digits"))
        .select(pan.card_bin(digits), pan.card_last4(digits), pan.masked_display(digits), pan.pan_error(digits))
        .first()
    )
    if isinstance(expected, tuple):
        assert tuple(row) == expected
    else:
        assert row[3] == expected


def test_check_digit_completes_any_number(spark):
    made = spark.range(200).select(
        pan.with_check_digit(F.lpad((F.col("id") * 7919131313).cast("string"), 15, "4"), 15).alias("n")
    )
    assert made.where(~pan.luhn_valid(F.col("n"))).count() == 0


ODD = """203.0.113.45 10.20.30.0 127.0.0.1 224.0.0.1 239.1.1.1 240.0.0.1 256.1.1.1 01.2.3.4 1.2.3 1.2.3.4.5
abc 2001:db8::1 :: ::1 1:: fe80::1%eth0 fe80::1% ff02::1 ::ffff:1.2.3.4 1:2:3:4:5:6:7:8 1:2:3:4:5:6:7::
::2:3:4:5:6:7:8 1::2::3 :1:2:3:4:5:6:7:8 1:2:3:4:5:6:7:8:9 12345:: g::1 ::1.2.3.400 1:2:3:4:5:6:1.2.3.4
1:2:3:4:5:6:7:1.2.3.4 2001:DB8::A 0:0:0:0:0:0:0:0 1:0:0:2:0:0:3:4 ffff::/64 : ::: 1:::2""".split()


def _expected(text, v4, v6):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None, ip.NOT_AN_ADDRESS
    if address.is_multicast:
        return None, ip.MULTICAST
    prefix = v4 if address.version == 4 else v6
    network = ipaddress.ip_network(f"{text.split('%')[0]}/{prefix}", strict=False)
    return str(network.network_address), None


@pytest.mark.parametrize(("v4", "v6"), [(24, 64), (20, 52), (8, 33)])
def test_truncation_agrees_with_ipaddress(spark, v4, v6):
    random.seed(7)
    texts = [*ODD, "", " 1.2.3.4", "1.2.3.4\n"]
    for _ in range(150):
        groups = [random.choice([0, 0, 1, 0xABCD, random.randrange(65536)]) for _ in range(8)]
        address = ipaddress.IPv6Address(int("".join(f"{g:04x}" for g in groups), 16))
        texts += [str(address), address.exploded, ":".join(f"{g:x}" for g in groups)]
        texts.append(str(ipaddress.IPv4Address(random.randrange(2**32))))
    found = (
        spark.createDataFrame([(t,) for t in texts], "ip string")
        .select("ip", ip.truncate(F.col("ip"), v4, v6).alias("x"))
        .select("ip", "x.network", "x.error")
        .collect()
    )
    assert [(r.ip, (r.network, r.error)) for r in found] == [(t, _expected(t, v4, v6)) for t in texts]


def test_representative_host(spark):
    texts = ["203.0.113.0/24", "203.0.113.0", "203.0.113.5", "10.0.0.0", "2001:db8::/64", None]
    found = spark.createDataFrame([(t,) for t in texts], "s string").select(
        ip.representative_host(F.col("s"))
    )
    assert [r[0] for r in found.collect()] == [
        "203.0.113.1", "203.0.113.1", "203.0.113.5", "10.0.0.1", "2001:db8::", None,
    ]
