"""Small change logs for tests."""

from __future__ import annotations

from rowtide.schemas import POSITIONED_LOG

COLUMNS = [("id", 20, 1), ("name", 25, 0), ("score", 701, 0)]


def relation(namespace="public", name="t", columns=COLUMNS):
    return (namespace, name, [tuple(c) for c in columns])


def tuple_(*values):
    """Tuple columns: None is NULL, `...` is unchanged, bytes is binary."""
    out = []
    for v in values:
        if v is None:
            out.append(("n", None))
        elif v is ...:
            out.append(("u", None))
        elif isinstance(v, bytes):
            out.append(("b", v.decode()))
        else:
            out.append(("t", str(v)))
    return out


def message(kind, commit_pos=None, ord=None, relation_id=1, old=None, new=None, **more):
    row = {
        "arrival": more.get("arrival"),
        "kind": kind,
        "xid": more.get("xid"),
        "commit_pos": commit_pos,
        "ord": ord,
        "wal_pos": more.get("wal_pos"),
        "end_pos": more.get("end_pos"),
        "relation_id": relation_id,
        "relation_ids": more.get("relation_ids"),
        "relation": more.get("relation"),
        "old_tuple": old,
        "new_tuple": new,
        "reply_requested": more.get("reply_requested"),
    }
    return tuple(row.values())


def announce(commit_pos=0, ord=0, relation_id=1, **kw):
    return message("R", commit_pos, ord, relation_id, relation=relation(**kw))


def frame(spark, messages):
    return spark.createDataFrame(messages, POSITIONED_LOG)


def workload(n):
    """Inserts with now and then an update two back and a delete four back."""
    out, pos = [announce()], 0
    for i in range(1, n + 1):
        steps = [("I", None, tuple_(i, f"Stream {i}", 1.0))]
        if i % 4 == 0 and i > 2:
            steps.append(("U", None, tuple_(i - 2, f"Stream {i - 2}", 11.0)))
        if i % 6 == 0 and i > 4:
            steps.append(("D", tuple_(i - 4, None, None), None))
        for kind, old, new in steps:
            pos += 10
            out.append(message(kind, pos, 0, old=old, new=new))
    return out
