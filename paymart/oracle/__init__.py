"""DuckDB SQL twins of the registered queries (the cross-engine correctness check)."""


def load_all() -> dict[str, str]:
    from paymart.oracle import queries_core, queries_analytics
    out = dict(queries_core.SQL)
    out.update(queries_analytics.SQL)
    return out
