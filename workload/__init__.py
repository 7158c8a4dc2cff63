"""Driver queries: operators wired to the test tables, each with its SQL check."""

from workload import files, reports, texts, tickets, vectors

MODULES = (tickets, reports, texts, vectors, files)

QUERIES = {name: fn for m in MODULES for name, (fn, _) in m.QUERIES.items()}
SQL = {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql is not None}
