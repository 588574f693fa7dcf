"""Column rules: each takes Columns (or names) and returns a Column."""

from claimlake.functions.coerce import *  # noqa: F401,F403
from claimlake.functions.measures import *  # noqa: F401,F403
from claimlake.functions.rules import *  # noqa: F401,F403
