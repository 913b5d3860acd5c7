import hashlib
import math

import pytest

from helpers import docs_frame, odd_rows, spaced
from insight.llm.mixing import mix_plan, mixed, source_targets


def plain_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, target = 1.5 * sum(sizes.values()), {}
    open_ = list(order)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def draw(doc_id, body, number):
    body = "null" if body is None else hashlib.md5(body.encode()).hexdigest()
    text = f"mix-1:{'null' if doc_id is None else doc_id}:{body}:{number}"
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16) / 2**48


def plain_plan(rows):
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(spaced(t))
    target = plain_targets(sizes)
    out, seen = [], {}
    for i, t, _, s in rows:
        rate = target[s] / sizes[s] if sizes[s] else 0.0
        number = seen[i, t, s] = seen.get((i, t, s), -1) + 1
        n = math.floor(rate) + (draw(i, t, number) < rate - math.floor(rate))
        out.append((i, len(spaced(t)), sizes[s], round(target[s], 6), len(spaced(t)) * n, n))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows", [
    odd_rows(),
    [(i, "w " * (1 + i * i % 50), "en", "hot" if i % 3 else f"s{i % 11}") for i in range(200)],
    [(1, "a b c", "en", None)],
    [(1, None, None, "a"), (2, "", None, "b")],
], ids=["odd", "hot source", "one null source", "no words"])
def test_plan_equals_the_plain_version(spark, rows):
    docs = docs_frame(spark, rows)
    plan = mix_plan(docs)
    got = sorted(((r[0], r[1], r[2], round(r[3], 6), r[4], r[5]) for r in plan.collect()), key=repr)
    assert got == plain_plan(rows)
    assert got == sorted(((r[0], r[1], r[2], round(r[3], 6), r[4], r[5]) for r in mix_plan(docs).collect()), key=repr)


def test_the_mix_repeats_rows_with_their_columns(spark):
    rows = odd_rows()
    docs = docs_frame(spark, rows)
    out = mixed(docs)
    assert out.columns == docs.columns
    want = {}
    for i, _, _, _, _, n in plain_plan(rows):
        want[i] = want.get(i, 0) + n
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, "w " * (20 + i % 30), "en", f"s{i % 5}" if i % 2 else "hot") for i in range(4000)]
    by = {}
    for r, (i, _, _, s) in zip(sorted(mix_plan(docs_frame(spark, rows)).collect(), key=lambda r: r["doc_id"]), rows):
        assert r["taken"] <= 2 * r["size"]
        t = by.setdefault(s, [r["target"], 0])
        t[1] += r["taken"]
    assert all(abs(got - want) < 0.1 * want for want, got in by.values())


def test_shared_ids_and_equal_rows_come_near_the_targets(spark):
    """A source of null ids, one of a single id, one of a single row repeated; reruns agree."""
    rows = [(None, f"null {i} " * 20, "en", "nulls") for i in range(1500)] + [(5, f"five {i} " * 15, "en", "five") for i in range(1200)]
    rows += [(6, "the same row " * 10, "en", "same")] * 1500 + [(i, "w " * 30, "en", "d") for i in range(100, 1100)]
    docs = docs_frame(spark, rows).repartition(7)
    out = mix_plan(docs).collect()
    by = {}
    for r in out:
        t = by.setdefault(round(r["target"], 3), [r["source_size"], 0])
        t[1] += r["taken"]
    assert len(by) == 4 and all(abs(got - want) < 0.05 * want for want, (_, got) in by.items())
    got = sorted(((r[0], r[1], r[2], round(r[3], 6), r[4], r[5]) for r in out), key=repr)
    assert got == plain_plan(rows)
    assert mixed(docs).count() == sum(r[5] for r in got)


def test_salted_sources(spark, monkeypatch):
    """With more sources than are broadcast the plan joins by salts; rows and draws stay."""
    from insight.llm import mixing
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 3)
    rows = [(i, "w " * (1 + i % 50), "en", "hot" if i % 3 else f"s{i % 11}") for i in range(300)] + odd_rows()
    got = sorted(((r[0], r[1], r[2], round(r[3], 6), r[4], r[5]) for r in mix_plan(docs_frame(spark, rows)).collect()), key=repr)
    assert got == plain_plan(rows)


def test_empty_table(spark):
    docs = docs_frame(spark, [])
    assert mix_plan(docs).count() == 0 and mixed(docs).count() == 0
    assert source_targets(spark.createDataFrame([], "source string, size bigint")).count() == 0
