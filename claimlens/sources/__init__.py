"""Scans, sinks and the policy view."""

from claimlens.sources.views import policy_view, load_table, policy_cte, POLICY_TIE_KEYS  # noqa: F401
from claimlens.sources.io import *  # noqa: F401,F403
