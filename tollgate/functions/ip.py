"""IP address expressions for both families, without Python workers.

IPv6 text is read several times over. ``bind`` names an intermediate value inside one
expression, so the optimizer can move these columns about without multiplying them; IPv4 text
never enters those branches.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgate.functions.let import bind

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_V4 = rf"^{_OCTET}(\.{_OCTET}){{3}}\z"
_V4_TAIL = rf"^(.*:){_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"
_GROUPS = r"([0-9a-f]{1,4}(:[0-9a-f]{1,4})*)"
_FULL = r"^([0-9a-f]{1,4}:){7}[0-9a-f]{1,4}\z"

NOT_AN_ADDRESS = "not an IPv4 or IPv6 address"
MULTICAST = "multicast addresses must not be stored"


def is_v4(ip: Column) -> Column:
    return ip.rlike(_V4)


def _octet(ip: Column, index: int) -> Column:
    return F.split_part(ip, F.lit("."), F.lit(index + 1))


def _v4_network(ip: Column, prefix: int) -> Column:
    """Keep whole octets, mask the one the prefix cuts, zero the rest."""
    texts = []
    for i in range(4):
        bits = min(max(prefix - 8 * i, 0), 8)
        if bits == 0:
            texts.append(F.lit("0"))
        elif bits == 8:
            texts.append(_octet(ip, i))
        else:
            mask = (0xFF << (8 - bits)) & 0xFF
            texts.append(_octet(ip, i).cast("int").bitwiseAND(F.lit(mask)).cast("string"))
    return F.concat_ws(".", *texts)


def _undotted(text: Column) -> Column:
    """Rewrite a dotted tail as two hex groups."""

    def pair(high: int) -> Column:
        value = F.regexp_extract(text, _V4_TAIL, high).cast("int") * 256 + F.regexp_extract(
            text, _V4_TAIL, high + 1
        ).cast("int")
        return F.lower(F.hex(value))

    return F.when(
        text.rlike(_V4_TAIL),
        F.concat(F.regexp_extract(text, _V4_TAIL, 1), pair(2), F.lit(":"), pair(4)),
    ).otherwise(text)


def _split_groups(text: Column) -> Column:
    def side(number: int) -> Column:
        part = F.split_part(text, F.lit("::"), F.lit(number))
        return F.when(part == "", F.array().cast("array<string>")).otherwise(F.split(part, ":"))

    def fill(sides: Column) -> Column:
        missing = 8 - F.size(sides["left"]) - F.size(sides["right"])
        return F.when(
            missing >= 1,
            F.concat(sides["left"], F.array_repeat(F.lit("0"), missing), sides["right"]),
        )

    short = bind(F.struct(side(1).alias("left"), side(2).alias("right")), fill)
    return F.when(text.rlike(_FULL), F.split(text, ":")).when(
        text.rlike(rf"^{_GROUPS}?::{_GROUPS}?\z"), short
    )


def v6_groups(ip: Column) -> Column:
    """The eight hex groups as array<string>; null unless the text is an IPv6 address."""
    plain = F.lower(F.regexp_replace(ip, r"^([^%]+)%[^%]+\z", "$1"))
    return F.when(
        ip.contains(":"), bind(plain, lambda text: bind(_undotted(text), _split_groups))
    )


def _group(groups: Column, index: int) -> Column:
    return F.conv(F.get(groups, F.lit(index)), 16, 10).cast("bigint")


def _masked_v6(groups: Column, prefix: int) -> Column:
    """The network's eight groups, uncompressed."""
    texts = []
    for i in range(8):
        bits = min(max(prefix - 16 * i, 0), 16)
        mask = (0xFFFF << (16 - bits)) & 0xFFFF
        group = F.lower(F.hex(_group(groups, i).bitwiseAND(F.lit(mask))))
        texts.append(F.lit("0") if mask == 0 else group)
    return F.concat_ws(":", *texts)


def _compress(text: Column) -> Column:
    """Replace the first longest run of two or more zero groups by '::'."""
    patterns = [
        rf"^(.*?)(?:^|:)0(?::0){{{run - 1}}}(?::|\z)(.*)\z" for run in range(8, 1, -1)
    ]
    result = F.when(text.rlike(patterns[0]), F.lit("::"))
    for pattern in patterns[1:]:
        result = result.when(text.rlike(pattern), F.regexp_replace(text, pattern, "$1::$2"))
    return result.otherwise(text)


def _outcome(network: Column | None, error: str | None) -> Column:
    text = F.lit(None).cast("string")
    return F.struct(
        (text if network is None else network).alias("network"),
        (text if error is None else F.lit(error)).alias("error"),
    )


def truncate(ip: Column, ipv4_prefix: int = 24, ipv6_prefix: int = 64) -> Column:
    """struct(network, error): the network address at the prefix, or why it may not be stored.

    The error does not repeat the address.
    """

    def v6(groups: Column) -> Column:
        return (
            F.when(groups.isNull(), _outcome(None, NOT_AN_ADDRESS))
            .when(F.get(groups, F.lit(0)).rlike("^ff[0-9a-f]{2}"), _outcome(None, MULTICAST))
            .otherwise(_outcome(bind(_masked_v6(groups, ipv6_prefix), _compress), None))
        )

    return (
        F.when(
            is_v4(ip),
            F.when(
                _octet(ip, 0).cast("int").between(224, 239), _outcome(None, MULTICAST)
            ).otherwise(_outcome(_v4_network(ip, ipv4_prefix), None)),
        )
        .when(ip.contains(":"), bind(v6_groups(ip), v6))
        .otherwise(_outcome(None, NOT_AN_ADDRESS))
    )


def address_bits(ip: Column) -> Column:
    """The address as a text of 32 (IPv4) or 128 (IPv6) binary digits, null if it is none.

    Its first n characters identify the enclosing network of prefix length n.
    """

    def binary(number: Column, width: int) -> Column:
        return F.lpad(F.bin(number), width, "0")

    v4 = F.concat(*[binary(_octet(ip, i).cast("bigint"), 8) for i in range(4)])
    v6 = F.array_join(
        F.transform(v6_groups(ip), lambda g: binary(F.conv(g, 16, 10).cast("bigint"), 16)), ""
    )
    return F.when(is_v4(ip), v4).when(ip.contains(":"), v6)


def representative_host(subnet: Column) -> Column:
    """Drop a '/n' suffix; a four-octet address ending in 0 becomes host 1."""
    host = F.split_part(subnet, F.lit("/"), F.lit(1))
    return F.regexp_replace(host, r"^([^.]*\.[^.]*\.[^.]*)\.0\z", "$1.1")
