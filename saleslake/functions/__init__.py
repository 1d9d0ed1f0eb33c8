"""Column expressions (scalar functions of the reference), all built-ins."""
from .columns import *  # noqa: F401,F403
