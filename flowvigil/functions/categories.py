"""Category expressions: services, states, protocols, directions, labels, severities."""

from pyspark.sql import Column, functions as F

from flowvigil.functions.address import is_internal
from flowvigil.functions.coercion import as_col, let, strip
from flowvigil.schema import CONN_STATES, SEVERITIES

# Arrow labels of the flow direction and their column-safe names.
DIRECTION_NAMES = {
    "i↔i": "i_i",
    "i→e": "i_to_e",
    "e→i": "e_to_i",
    "e↔e": "e_e",
}

# Application protocols that get a "_tls" form when carried over TLS.
TLS_BASES = ("http", "smtp", "imap", "pop3")


def lookup(key: Column, mapping: dict[str, str]) -> Column:
    """Value of ``key`` in a literal map, the key itself when it is not in the map."""
    if not mapping:
        return key
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key)


def service_norm(service: str | Column, mapping: dict[str, str], default: str = "other") -> Column:
    """Canonical service of a comma-separated service list.

    Tunnels win, then QUIC over TLS, then "TLS plus something", then the first token.
    """

    def choose(tokens: Column) -> Column:
        over_tls = F.array_contains(tokens, "ssl")
        plain = F.try_element_at(F.filter(tokens, lambda t: t != "ssl"), F.lit(1))
        mapped = lookup(F.coalesce(F.when(over_tls, plain), F.try_element_at(tokens, F.lit(1))), mapping)
        return (
            F.when(F.size(tokens) == 0, F.lit(default))
            .when(F.array_contains(tokens, "ayiya"), "tunnel_ayiya")
            .when(F.array_contains(tokens, "quic") & over_tls, "quic_tls")
            .when(over_tls & plain.isin(*TLS_BASES), F.concat(plain, F.lit("_tls")))
            .otherwise(mapped)
        )

    text = F.lower(F.coalesce(as_col(service).cast("string"), F.lit("")))
    tokens = F.filter(F.transform(F.split(text, ","), strip), lambda t: t != "")
    return let(tokens, choose)


def flow_direction(orig_h: str | Column, resp_h: str | Column) -> Column:
    code = is_internal(orig_h).cast("int") * 2 + is_internal(resp_h).cast("int")
    # Indexed by 2 * (source is internal) + (target is internal).
    return F.array(*[F.lit(name) for name in ("e↔e", "e→i", "i→e", "i↔i")])[code]


def _blank_as(value: Column, fill: str) -> Column:
    return F.when(value.isNull() | value.isin("-", "", "nan", "NAN"), fill).otherwise(value)


def conn_state_norm(value: str | Column) -> Column:
    state = F.upper(strip(value))
    return F.when(state.isin(*CONN_STATES), state).otherwise("UNK")


def proto_norm(value: str | Column) -> Column:
    return _blank_as(F.lower(strip(value)), "unknown")


def service_feature(value: str | Column) -> Column:
    return _blank_as(F.lower(strip(value)), "unknown")


def direction_feature(value: str | Column) -> Column:
    text = strip(value)
    named = lookup(text, DIRECTION_NAMES)
    return F.when(named.isin(*DIRECTION_NAMES.values()), named).otherwise("unknown")


def attack_type_norm(value: str | Column, label: str) -> Column:
    """Attack type for rows of one known label; normal rows always carry 'none'."""
    if label == "normal":
        return F.lit("none")
    kind = F.lower(strip(value))
    return F.when(kind.isNull() | kind.isin("", "none"), "unknown_attack").otherwise(kind)


def severity_rank(severity: str | Column) -> Column:
    """0, 1, 2 for low, med, high; anything else ranks 0."""
    severity = as_col(severity)
    rank = F.lit(0)
    for position, name in enumerate(SEVERITIES):
        rank = F.when(severity == name, position).otherwise(rank)
    return rank.cast("int")


def severity(high: Column, med: Column) -> Column:
    return F.when(high, "high").when(med, "med").otherwise("low")
