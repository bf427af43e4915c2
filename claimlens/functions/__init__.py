"""Column-level helpers and distribution tails."""

from claimlens.functions.expr import *  # noqa: F401,F403
