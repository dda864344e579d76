"""Registered queries over the given tables, each with the SQL that must give the same rows."""

from catalogue import bronze, gold, labels, landing, quality, sinks, streams

MODULES = (gold, labels, quality, bronze, sinks, landing, streams)


def all_queries():
    return {name: run for module in MODULES for name, run in module.CATALOGUE.queries.items()}


def all_oracles():
    return {name: sql for module in MODULES for name, sql in module.CATALOGUE.oracles.items()}
