"""The named data flows: cleaning, star schema, rollups, marts, serving queries, profile."""
