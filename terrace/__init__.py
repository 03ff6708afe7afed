"""Layered analytics on Spark: raw files to cleaned tables to summaries and history."""

from terrace.profile import Aliased, Gap, Measure, Profile, Rule, Tier

__all__ = ["Aliased", "Gap", "Measure", "Profile", "Rule", "Tier"]
