"""The shipped hospital lakehouse: staging specs, curated derivations,
rulesets, published queries and the stand-in raw tables used for checks."""
