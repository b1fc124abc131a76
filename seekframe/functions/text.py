"""Text expressions: tokens, composed texts, non-null checks."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a maximal run of Unicode letters and digits, in lower case.
TOKEN_GAP = r"[^\p{L}\p{N}]+"
WHITESPACE = " \n\t\r"


def tokens(text: Column) -> Column:
    """Array of tokens in order of appearance; empty for a text without any."""
    return F.filter(F.split(F.lower(text), TOKEN_GAP), lambda t: t != "")


def required(name: str) -> Column:
    """The column, failing the job on NULL instead of letting a text go short."""
    return F.coalesce(F.col(name), F.raise_error(F.lit(f"NULL in required field {name}")))


def all_present(*columns: str) -> Column:
    """True, or a failed job for a NULL in any column; as a filter it cannot be pruned away."""
    condition = F.lit(True)
    for name in columns:
        message = F.lit(f"NULL in required field {name}")
        condition = condition & F.when(F.col(name).isNull(), F.raise_error(message)).otherwise(True)
    return condition


def compose(*names: str, sep: str = "\n") -> Column:
    """Join required text columns into the text that gets embedded."""
    return F.concat_ws(sep, *[required(n) for n in names])


def strip(text: Column) -> Column:
    """Remove blanks and line breaks at both ends, not only spaces."""
    return F.btrim(text, F.lit(WHITESPACE))
