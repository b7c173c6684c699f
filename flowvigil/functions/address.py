"""IP address predicates as JVM-side Column expressions, IPv4 and IPv6.

IPv4 text is tested by one regular expression. IPv6 text is first written out as its 32
hexadecimal digits, which turns a network into a digit prefix. No Python worker is involved.
"""

from pyspark.sql import Column, functions as F

from flowvigil.functions.coercion import as_col, let

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_QUAD = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUPS = r"^(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?$"
_QUAD_TAIL = rf"^(.*:)({_QUAD})$"

# Dotted-quad prefixes of the internal (private or link-local special-purpose)
# networks 0/8, 10/8, 127/8, 169.254/16, 172.16/12, 192.0.0/24 without .9 and .10, 192.0.2/24,
# 192.168/16, 198.18/15, 198.51.100/24, 203.0.113/24, 240/4.
INTERNAL_V4 = (
    r"0\.",
    r"10\.",
    r"127\.",
    r"169\.254\.",
    r"172\.(?:1[6-9]|2[0-9]|3[01])\.",
    r"192\.0\.0\.(?!(?:9|10)$)",
    r"192\.0\.2\.",
    r"192\.168\.",
    r"198\.1[89]\.",
    r"198\.51\.100\.",
    r"203\.0\.113\.",
    r"2(?:4[0-9]|5[0-5])\.",
)

# The same networks as digits of an IPv4-mapped IPv6 address.
INTERNAL_MAPPED = (
    "00", "0a", "7f", "a9fe", "ac1", "c00000(?!09|0a)", "c00002", "c0a8", "c61[23]",
    "c63364", "cb0071", "f",
)

# Digit prefixes of ::1, ::, 64:ff9b:1::/48, 100::/64, 2001::/23 without its
# globally reachable parts, 2001:db8::/32, 2002::/16, fc00::/7, fe80::/10.
INTERNAL_V6 = (
    "0{31}1",
    "0{32}",
    "0064ff9b0001",
    "0100000000000000",
    "20010[01]",
    "20010db8",
    "2002",
    "f[cd]",
    "fe[89ab]",
)
# 2001:1::1, 2001:1::2, 2001:3::/32, 2001:4:112::/48, 2001:20::/28, 2001:30::/28.
GLOBAL_V6 = (
    "200100010{23}[12]",
    "20010003",
    "200100040112",
    "2001002",
    "2001003",
)

_V4_VALID = f"^{_QUAD}$"
_V4_INTERNAL = f"^(?={_QUAD}$)(?:{'|'.join(INTERNAL_V4)})"
_V6_INTERNAL = (
    f"^(?:0{{20}}ffff(?:{'|'.join(INTERNAL_MAPPED)})"
    f"|(?!{'|'.join(GLOBAL_V6)})(?:{'|'.join(INTERNAL_V6)}))"
)


def is_ipv4(ip: str | Column) -> Column:
    """Strict dotted quad: four numbers up to 255 without leading zeros."""
    return as_col(ip).rlike(_V4_VALID)


def _quad_groups(quad: Column) -> Column:
    """Two hexadecimal groups for a dotted quad."""
    octets = F.transform(F.split(quad, r"\."), lambda o: F.lpad(F.hex(o.try_cast("bigint")), 2, "0"))
    return let(octets, lambda o: F.concat(o[0], o[1], F.lit(":"), o[2], o[3]))


def _groups(text: Column) -> Column:
    return F.filter(F.split(text, ":"), lambda g: g != "")


def _digits(sides: Column) -> Column:
    """32 digits from the texts left and right of '::', NULL for a malformed address."""
    head, rest = sides[0], F.coalesce(F.try_element_at(sides, F.lit(2)), F.lit(""))
    filled = F.size(_groups(head)) + F.size(_groups(rest))
    shape_ok = F.when(F.size(sides) == 2, filled <= 7).otherwise(
        (F.size(sides) == 1) & (filled == 8)
    )
    groups = F.concat(
        _groups(head),
        F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - filled, F.lit(0))),
        _groups(rest),
    )
    digits = F.array_join(F.transform(groups, lambda g: F.lpad(F.lower(g), 4, "0")), "")
    return F.when(head.rlike(_GROUPS) & rest.rlike(_GROUPS) & shape_ok, digits)


def ipv6_hex(ip: str | Column) -> Column:
    """The address as 32 hexadecimal digits, NULL when it is not valid IPv6."""
    ip = as_col(ip)
    # A zone identifier must be non-empty and hold no second percent sign.
    zone_ok = ~ip.contains("%") | ip.rlike("^[^%]+%[^%]+$")

    def expand(address: Column) -> Column:
        # A dotted-quad tail stands for the last two groups.
        return F.when(
            address.rlike(_QUAD_TAIL),
            F.concat(
                F.regexp_extract(address, _QUAD_TAIL, 1),
                _quad_groups(F.regexp_extract(address, _QUAD_TAIL, 2)),
            ),
        ).otherwise(address)

    body = let(F.substring_index(ip, "%", 1), expand)
    return F.when(ip.contains(":") & zone_ok, let(F.split(body, "::"), _digits))


def is_valid_ip(ip: str | Column) -> Column:
    """TRUE for a well-formed IPv4 or IPv6 address, FALSE otherwise (also for NULL)."""
    ip = as_col(ip)
    valid = F.when(ip.contains(":"), ipv6_hex(ip).isNotNull()).otherwise(is_ipv4(ip))
    return F.coalesce(valid, F.lit(False))


def is_internal(ip: str | Column) -> Column:
    """Private or link-local. Invalid and missing addresses are external.

    An IPv4-mapped IPv6 address has the standing of the IPv4 address inside it.
    """
    ip = as_col(ip)
    internal = F.when(ip.contains(":"), ipv6_hex(ip).rlike(_V6_INTERNAL)).otherwise(
        ip.rlike(_V4_INTERNAL)
    )
    return F.coalesce(internal, F.lit(False))
