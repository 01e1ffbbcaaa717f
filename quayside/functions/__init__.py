"""Column functions of SURVEY §2.9 (strings, dates, values)."""

from quayside.functions import dates, strings, values  # noqa: F401
from quayside.functions.util import col_of, quote  # noqa: F401
