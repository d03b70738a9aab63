"""Small feeds written by hand."""

import json

from rowtide import TableSpec, image_of_types

USERS = TableSpec(
    image=image_of_types(username="string", password="string", enabled="integer", ts="long", country="string"),
    record_key=("username",),
    partition=("country",),
)

C1, C2, C3 = "20240101000000000", "20240102000000000", "20240103000000000"


def user(name, password="p", ts=1, country="SG", enabled=1, **more):
    return {"username": name, "password": password, "enabled": enabled, "ts": ts, "country": country, **more}


def event(op, before=None, after=None, pos=0, file="log.000001", **payload):
    source = {"db": "auth", "table": "users", "file": file, "pos": pos, "row": 0, "ts_ms": 0}
    body = {"before": before, "after": after, "source": source, "op": op, "ts_ms": 0, "transaction": None, **payload}
    return json.dumps({"schema": {"type": "struct"}, "payload": body})


def feed(spark, *values, timestamp=0):
    return spark.createDataFrame([(v, timestamp) for v in values], "value string, timestamp long")


def records(spark, *commits, spec=USERS, **options):
    """Records of ``(commit, [events])`` pairs."""
    from rowtide.operators.decode import parse
    from rowtide.operators.route import to_records

    parts = [to_records(parse(feed(spark, *events), spec.image), spec, c, **options) for c, events in commits]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
