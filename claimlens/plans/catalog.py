"""Import every query module so that the registry is complete."""

from claimlens.plans import q_segments, q_clean, q_profile, q_stats, q_ml, q_io, q_more, q_checks  # noqa: F401
