"""Queries over the given tables, each with an independent SQL answer where SQL can give one."""


def QUERIES_AND_ORACLES():
    from workloads import documents, people, scalars, warehouse  # noqa: F401
    from workloads.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
