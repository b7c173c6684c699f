"""Per-flow signals used by the rule detectors."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from flowvigil.functions.coercion import as_col
from flowvigil.schema import FAIL_STATES, SUCCESS_STATES


def time_bin(ts: str | Column, width: int) -> Column:
    """Start of the epoch-aligned tumbling window of ``width`` seconds."""
    return F.floor(as_col(ts) / width).cast("bigint") * width


def rebin(start: str | Column, width: int) -> Column:
    """Start of the wider window that holds a whole-second window start."""
    start = as_col(start)
    return start - F.pmod(start, F.lit(width).cast("bigint"))


def syn_noack(history: str | Column) -> Column:
    """1.0 when a SYN was seen and no SYN-ACK in either direction."""
    history = as_col(history)
    return (history.contains("S") & ~F.lower(history).contains("h")).cast("double")


def echo_like(history: str | Column) -> Column:
    """Originator payload without responder payload."""
    history = as_col(history)
    return history.contains("D") & ~history.contains("d")


def failed(conn_state: str | Column) -> Column:
    return as_col(conn_state).isin(*FAIL_STATES)


def succeeded(conn_state: str | Column) -> Column:
    return as_col(conn_state).isin(*SUCCESS_STATES)


def any_of(tests: list[Column]) -> Column:
    """OR over tests, a NULL test counting as FALSE."""
    return reduce(or_, [F.coalesce(t, F.lit(False)) for t in tests])


def in_set(value: str | Column, members) -> Column:
    """Membership that also accepts an empty set."""
    members = list(members)
    return as_col(value).isin(*members) if members else F.lit(False)
