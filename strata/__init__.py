"""strata: a PySpark-native lakehouse library.

Raw sources are staged with typed, NULL-tolerant casts, kept current with
keyed upserts, derived into a star schema, checked by declarative
data-quality rulesets and queried through a read-only SQL surface.
Everything is expressed as DataFrame / SQL plans so Catalyst and AQE choose
the physical strategy.
"""

from strata.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
