"""roadlens — road-incident analytics as lazy Spark DataFrame / SQL plans.

Layers:

* ``sources``   — CSV / Parquet readers, landing zone, sinks, file checks.
* ``functions`` — column-level helpers (parsing, labels, type-aware fills).
* ``operators`` — DataFrame -> DataFrame building blocks: dedup, cleaning,
  dense keys, star schema, validation, profiling.
* ``plans``     — the business questions, chart datasets and the ETL run.

Every operator returns a lazy DataFrame; collection is the caller's job.
"""

__version__ = "0.1.0"

_EXPORTS = {
    "raw_accidents": "roadlens.fixture",
    "clean_all": "roadlens.operators.clean",
    "build_star": "roadlens.operators.star",
    "run_etl": "roadlens.plans.etl",
    "read_star": "roadlens.sources.tables",
    "register_star": "roadlens.sources.tables",
    "read_accident_csvs": "roadlens.sources.csv",
}


def __getattr__(name):
    """Lazy top-level shortcuts (importing pyspark only when used)."""
    if name in _EXPORTS:
        import importlib

        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)
