"""Prompt templates used by the registered queries.

The reference's own prompt files are not part of its checkout; these are our
texts with the same placeholders."""

SCORE_TEMPLATE = "Score the description of property {PROPERTY_ID}.\n\nDescription:\n{DESCRIPTION}\n\nReturn JSON."
BASE_PROMPT = "Summarize what guests say about this listing in five sections."

# Tier insight request (placeholders as the reference's correlation prompt uses).
INSIGHT_TEMPLATE = ("Area {ZIPCODE}: listings at or above {HIGH_THRESHOLD} (top {TOP_PERCENTILE}%) versus at or "
                    "below {LOW_THRESHOLD} (bottom {BOTTOM_PERCENTILE}%).\n\n{FEATURE_COMPARISON}\n\n"
                    "High tier examples:\n{HIGH_TIER_DESCRIPTIONS}\n\nLow tier examples:\n{LOW_TIER_DESCRIPTIONS}")
NO_DESCRIPTIONS = "No descriptions available."
