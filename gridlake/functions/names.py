"""Bucket-name rules over a column of names.

Each rule is a (violation predicate, message) pair; ``name_failures`` turns
a name into the array of messages of the rules it breaks, so a whole column
of candidate names is checked in one projection. ``name_verdict`` renders
that array the way the reference reports it: ``Success`` or ``Failed!``
followed by one message per line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rule messages and verdict words, in the reference's order.
MSG_LENGTH = "Bucket name must be between 3 and 63 characters."
MSG_CHARSET = "Bucket name should contain only lowercase, numbers, periods (.), dashes (-)"
MSG_UNDERSCORE = "Bucket name cannot contain underscore (_)"
MSG_TRAILING_DASH = "Bucket name cannot end with dash (-)"
MSG_DOUBLE_PERIOD = "Bucket name cannot contain double periods (..)"
MSG_DASH_PERIOD = "Bucket name cannot have dashes and periods next to each other"
MSG_IP_FORM = "Bucket name cannot be in IP address format"
VERDICT_OK = "Success"
VERDICT_FAILED = "Failed!"
# The two patterns that decide which names are reported.
CHARSET_RE = r"^[a-z0-9.-]+$"
IP_FORM_RE = r"^(\d{1,3}\.){3}\d{1,3}$"


def name_rules(name: Column, min_len: int = 3, max_len: int = 63) -> list[tuple[Column, str]]:
    """(violated, message) per rule. The length bounds are inclusive."""
    n = F.length(name)
    return [
        ((n < F.lit(min_len)) | (n > F.lit(max_len)), MSG_LENGTH),
        (~name.rlike(CHARSET_RE), MSG_CHARSET),
        (F.instr(name, "_") > 0, MSG_UNDERSCORE),
        (name.endswith("-"), MSG_TRAILING_DASH),
        (F.instr(name, "..") > 0, MSG_DOUBLE_PERIOD),
        ((F.instr(name, ".-") > 0) | (F.instr(name, "-.") > 0), MSG_DASH_PERIOD),
        (name.rlike(IP_FORM_RE), MSG_IP_FORM),
    ]


def name_failures(name: Column | str, min_len: int = 3, max_len: int = 63) -> Column:
    """Array of the messages of every rule ``name`` breaks (empty = valid)."""
    c = F.col(name) if isinstance(name, str) else name
    msgs = [F.when(bad, F.lit(msg)) for bad, msg in name_rules(c, min_len, max_len)]
    return F.filter(F.array(*msgs), lambda m: m.isNotNull())


def name_verdict(name: Column | str, min_len: int = 3, max_len: int = 63) -> Column:
    """``Success``, or ``Failed!`` and the broken rules' messages, one per line.

    A NULL name has no verdict (NULL).
    """
    c = F.col(name) if isinstance(name, str) else name
    fails = name_failures(c, min_len, max_len)
    verdict = F.when(F.size(fails) == 0, F.lit(VERDICT_OK)).otherwise(
        F.concat_ws("\n", F.lit(VERDICT_FAILED), F.array_join(fails, "\n"))
    )
    return F.when(c.isNotNull(), verdict)
