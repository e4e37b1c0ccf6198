"""Named queries with the SQL that gives the same answer."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
