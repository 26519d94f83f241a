"""Registry of the engine's queries and their SQL counterparts."""

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    """Register a (spark, sf_dir) -> DataFrame function under its own name."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def load() -> None:
    """Import the modules that register queries."""
    from loomline.plans import queries_artifacts, queries_graph, queries_jobs, queries_logs, queries_pipelines  # noqa: F401
