"""Run registered queries next to their SQL and compare every value."""

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def connect(sf_dir):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return db


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if hasattr(v, "asDict"):
        return repr({k: plain(x) for k, x in v.asDict().items()})
    if isinstance(v, dict):
        return repr({k: plain(x) for k, x in sorted(v.items())})
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return repr(v)


def compare(spark, db, sf_dir, fn, sql):
    """Return a list of differences, empty when both sides agree."""
    df = fn(spark, sf_dir)
    names = df.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    mine = sorted(tuple(plain(r[i]) for i in order) for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    crossed = [w for w in ("CartesianProduct", "BroadcastNestedLoopJoin") if w in plan]
    if sql is None:
        return crossed, len(mine)
    rel = db.sql(sql)
    wide = [f"{c} is {t}" for c, t in zip(rel.columns, rel.types)
            if "HUGEINT" in str(t) or "DECIMAL" in str(t)]
    theirs_order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    if sorted(names) != sorted(rel.columns):
        return [f"columns {sorted(names)} / {sorted(rel.columns)}"], len(mine)
    theirs = sorted(tuple(plain(r[i]) for i in theirs_order) for r in rel.fetchall())
    out = wide + crossed
    if len(mine) != len(theirs):
        out.append(f"rows {len(mine)} / {len(theirs)}")
    diff = [(a, b) for a, b in zip(mine, theirs) if a != b]
    if diff:
        out.append(f"{len(diff)} rows differ {sorted(names)}, first: {diff[0]}")
    return out, len(mine)


def main(argv):
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    import __spark_entry__ as entry
    from blockstrata.session import local_session
    sf_dir = "/root/testdata/sf0.01"
    if argv and argv[0].startswith("/"):
        sf_dir, argv = argv[0], argv[1:]
    spark = local_session(8)
    db = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not argv or n in argv or any(
        a.endswith("*") and n.startswith(a[:-1]) for a in argv)]
    bad = 0
    for n in names:
        t = time.time()
        try:
            out, rows = compare(spark, db, sf_dir, queries[n], oracles.get(n))
        except Exception as exc:
            out, rows = [f"{type(exc).__name__}: {str(exc)[:700]}"], -1
        kind = "" if n in oracles else " (no sql)"
        print(f"{'ok ' if not out else 'BAD'} {n}{kind} rows={rows} {time.time() - t:.1f}s",
              *out, flush=True)
        bad += bool(out)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main(sys.argv[1:])
