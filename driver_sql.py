"""DuckDB twins of the registered queries, over the same driver tables."""

from __future__ import annotations

import driver_tables as tables

WINDOWS = (("1m", 1), ("5m", 5), ("1h", 60), ("24h", 1440))
MINUTE = 60_000
DAY = 86_400_000


def _list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _channel() -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in tables.CHANNELS.items())
    return f"CASE event_type {cases} END"


def txn(squeeze: int = 1, repeats=tables.REPEATS, late: bool = True, name: str = "txn") -> str:
    """CTE text of ``driver_tables.transactions``."""
    repeats = "".join(
        f" UNION ALL SELECT {every}, {delay}, {step}" for every, delay, step in repeats
    )
    shift = 20_000 if late else 0
    return f"""{name}_again(every, delay, step) AS (
  SELECT 1, CAST(0 AS BIGINT), 0{repeats}
), {name} AS (
  SELECT 'txn-' || event_id AS transaction_id, 'acc-' || user_id AS account_id,
    'merch-' || (event_id % 8) AS merchant_id, CAST(value AS DECIMAL(18,4)) AS amount,
    ({_list(tables.CURRENCIES)})[event_id % 5 + 1] AS currency,
    event_time, event_time + 10 + event_id % 37 AS processing_time, channel,
    '411111' AS card_bin, '1111' AS card_last4,
    ({_list(tables.SUBNETS)})[(event_id * 7 + user_id) % {tables.STORABLE} + 1] AS caller_ip_subnet,
    CASE WHEN k % 20 <> 0 THEN 'key-' || (k % 5) END AS api_key_id,
    'transactions:write' AS oauth_scope,
    CASE WHEN event_id % 10 = 0 THEN '0.9.0' ELSE '1.0.0' END AS masking_lib_version,
    'txn.api' AS source_topic, CAST(user_id % 12 AS INTEGER) AS source_partition,
    event_id * 10 + (CASE WHEN event_id % 50 = 0 THEN {shift} ELSE 0 END) + step AS source_offset
  FROM (
    SELECT e.*, {_channel()} AS channel, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
      a.step, {tables.START_MS} + ((epoch_us(ts) // 1000) - {tables.START_MS}) // {squeeze} + a.delay AS event_time
    FROM events e JOIN {name}_again a ON e.event_id % a.every = 0
  )
)"""


def bucket_velocity(source: str, name: str = "vel", keys: str = "account_id") -> str:
    """CTE: the eight bucket-mode columns by a self-join, nothing like the Spark formulation."""
    same = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    columns = ", ".join(
        f"CAST(count(*) FILTER (b.event_time // {MINUTE} >= a.event_time // {MINUTE} - {m}) AS INTEGER)"
        f" AS vel_count_{label}, CAST(sum(b.amount) FILTER (b.event_time // {MINUTE} >="
        f" a.event_time // {MINUTE} - {m}) AS DECIMAL(18,4)) AS vel_amount_{label}"
        for label, m in WINDOWS
    )
    return f"""{name} AS (
  SELECT a.transaction_id, a.source_offset, {columns}
  FROM {source} a JOIN {source} b ON {same}
    AND b.event_time // {MINUTE} >= a.event_time // {MINUTE} - 1440
    AND (b.event_time, b.source_partition, b.source_offset)
      <= (a.event_time, a.source_partition, a.source_offset)
  GROUP BY a.transaction_id, a.source_offset
)"""


def exact_velocity(source: str, name: str = "vel") -> str:
    columns = ", ".join(
        f"CAST(count(*) FILTER (b.event_time > a.event_time - {m * MINUTE}) AS INTEGER)"
        f" AS vel_count_{label}, CAST(sum(b.amount) FILTER (b.event_time > a.event_time - {m * MINUTE})"
        f" AS DECIMAL(18,4)) AS vel_amount_{label}"
        for label, m in WINDOWS
    )
    return f"""{name} AS (
  SELECT a.transaction_id, a.source_offset, {columns}
  FROM {source} a JOIN {source} b ON a.account_id = b.account_id
    AND b.event_time > a.event_time - {1440 * MINUTE} AND b.event_time <= a.event_time
  GROUP BY a.transaction_id, a.source_offset
)"""


def dedup(source: str, name: str = "uniq") -> str:
    """CTE: first copy per id, then again and again the first copy 48 h after the last kept one."""
    order = "event_time, source_partition, source_offset"
    return f"""kept_chain AS (
  SELECT transaction_id, min(({order})) AS kept FROM {source} GROUP BY transaction_id
  UNION ALL
  SELECT * FROM (
    SELECT t.transaction_id, min((t.event_time, t.source_partition, t.source_offset)) AS kept
    FROM kept_chain c JOIN {source} t ON t.transaction_id = c.transaction_id
      AND t.event_time >= c.kept[1] + {2 * DAY}
    GROUP BY t.transaction_id
  )
), {name} AS (
  SELECT t.* FROM {source} t JOIN kept_chain c ON t.transaction_id = c.transaction_id
    AND (t.event_time, t.source_partition, t.source_offset) = c.kept
)"""


def device(source: str, name: str = "dev") -> str:
    order = "event_time, source_partition, source_offset"
    return f"""{name}_gaps AS (
  SELECT *, CASE WHEN event_time - lag(event_time) OVER (PARTITION BY api_key_id ORDER BY {order})
    > {7 * DAY} THEN 1 ELSE 0 END AS back
  FROM {source} WHERE coalesce(api_key_id, '') <> ''
), {name}_spells AS (
  SELECT *, sum(back) OVER (PARTITION BY api_key_id ORDER BY {order}
    ROWS UNBOUNDED PRECEDING) AS spell FROM {name}_gaps
), {name} AS (
  SELECT transaction_id, source_offset,
    first_value(event_time) OVER w AS device_first_seen,
    CAST(row_number() OVER w AS INTEGER) AS device_txn_count, false AS device_known_fraud
  FROM {name}_spells WINDOW w AS (PARTITION BY api_key_id, spell ORDER BY {order})
)"""


def geo(name: str = "geo") -> str:
    """CTE: subnet to place, by the pool of subnets and the block list (IPv6 resolved by hand)."""
    v4 = [b for b in tables.BLOCKS if ":" not in b[0]]

    def number(ip: str) -> int:
        a, b, c, d = (int(x) for x in ip.split("."))
        return ((a * 256 + b) * 256 + c) * 256 + d

    def text(value) -> str:
        return "NULL" if value is None else f"'{value}'"

    rows = ", ".join(
        f"({number(net.split('/')[0])}, {int(net.split('/')[1])}, {text(country)}, {text(city)})"
        for net, country, city in v4
    )
    hosts = ", ".join(
        f"('{s}', {number(s) + 1})" for s in dict.fromkeys(tables.SUBNETS) if s and ":" not in s
    )
    return f"""{name}_block(net, len, country, city) AS (VALUES {rows}),
{name}_host(subnet, host) AS (VALUES {hosts}),
{name} AS (
  SELECT subnet AS caller_ip_subnet, country AS geo_country, city AS geo_city,
    'RESIDENTIAL' AS geo_network_class, CAST(0.9 AS FLOAT) AS geo_confidence
  FROM (
    SELECT *, row_number() OVER (PARTITION BY subnet ORDER BY len DESC) AS rank
    FROM {name}_host JOIN {name}_block
      ON host >= net AND host < net + CAST(pow(2, 32 - len) AS BIGINT)
  ) WHERE rank = 1
  UNION ALL SELECT '2001:db8:1:2::', 'DE', 'Berlin', 'RESIDENTIAL', CAST(0.9 AS FLOAT)
  UNION ALL SELECT '2001:db8::', 'DE', NULL, 'RESIDENTIAL', CAST(0.9 AS FLOAT)
)"""


CLOCK = "processing_time + 10 + source_offset * 13 % 401"
VEL = ", ".join(f"vel_count_{label}, vel_amount_{label}" for label, _ in WINDOWS)
VEL_OUT = ", ".join(
    f"vel_count_{label}, CAST(vel_amount_{label} AS DOUBLE) AS vel_amount_{label}" for label, _ in WINDOWS
)


def enriched(source: str = "uniq", name: str = "enr") -> str:
    """CTEs of the enriched record over unique transactions ``source``."""
    return f"""{bucket_velocity(source)}, {device(source)}, {geo()}, {name} AS (
  SELECT u.*, {VEL}, geo_country, geo_city, geo_network_class, geo_confidence,
    device_first_seen, device_txn_count, device_known_fraud,
    {CLOCK} AS enrichment_time, CAST({CLOCK} - processing_time AS INTEGER) AS enrichment_latency_ms
  FROM {source} u JOIN vel USING (transaction_id, source_offset)
    LEFT JOIN dev USING (transaction_id, source_offset) LEFT JOIN geo USING (caller_ip_subnet)
)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"
