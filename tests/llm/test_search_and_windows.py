"""Operators 11 to 13 against brute force, with nulls, empty and long texts, ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from netforensics.llm import best_position, whitening, window_dedup
from netforensics.llm.queries import SQL

SCHEMA = "doc_id long, text string, removed string, kept int, k0 string"


def _texts() -> list[str | None]:
    rnd = random.Random(5)
    words = ["alpha", "Beta", "gamma's", "don't", "é", "L'été", "12", "x_y", "zzz", "İstanbul", "人", "%%", "the", "the", "of"]
    say = lambda n: " ".join(rnd.choice(words) + (str(rnd.randint(0, 40)) if rnd.random() < 0.5 else "") for _ in range(n))
    shared, long = say(60), say(9000)
    texts = [None, "", " \n", "one", say(34), say(35), shared, "x " + shared + "\ty", shared, shared, say(20) + "\n" + shared + " " + say(20)]
    texts += ["ab " * 200, long, long[:8000], say(50) + " " + "\x1c" + shared.replace(" ", "  "), " ".join([shared, say(3), shared])]
    return texts + [say(rnd.randint(1, 120)) for _ in range(60)]


def _docs(spark, texts):
    rows = [(None if i == 40 else i // 2 if i in (50, 51) else i, t, "r", i, "k") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def _cut(texts: list[str | None], width: int) -> list[tuple[int, int, list[str]]]:
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    windows = Counter(tuple(w[s : s + width]) for w in words for s in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {s + d for s in range(len(w) - width + 1) if windows[tuple(w[s : s + width])] > 1 for d in range(width)}
        out.append((len(w), len(gone), [x for i, x in enumerate(w) if i not in gone]))
    return out


@pytest.mark.parametrize("width", [1, 4, 35])
@pytest.mark.parametrize("crowded", [False, True])
def test_windows_equal_brute_force(spark, monkeypatch, width, crowded):
    if crowded:  # many shards and a sketch that is nearly full must give the same rows
        monkeypatch.setattr(window_dedup, "WINDOWS", 97)
        monkeypatch.setattr(window_dedup, "CELL_BITS", 6)
    texts = _texts()
    rows = window_dedup.repeated_windows(_docs(spark, texts), width=width, columns=("kept",)).toDF("doc_id", "place", "n_words", "spans", "text").collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, gone, kept = _cut(texts, width)[r["place"]]
        assert (r["n_words"], sum(s["stop"] - s["start"] for s in r["spans"]), r["text"]) == (n, gone, " ".join(kept))
        assert all(a["stop"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:], strict=False))


def test_window_digests_tables_and_empty(spark):
    texts = _texts()
    docs = _docs(spark, texts)
    want = Counter(hashlib.sha256(" ".join(kept).encode()).hexdigest() for _, _, kept in _cut(texts, 35))
    got = window_dedup.digests(docs)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"] and Counter(r["kept_sha256"] for r in got.collect()) == want
    cut = window_dedup.remove_repeats(docs)
    assert cut.columns == docs.columns
    for r in cut.collect():
        _, gone, kept = _cut(texts, 35)[r["kept"]]
        assert r["text"] == (" ".join(kept) if gone else texts[r["kept"]])
    empty = spark.createDataFrame([], SCHEMA)
    assert window_dedup.digests(empty).count() == 0
    assert window_dedup.digests(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()["n_words"] == 0


def test_one_task_gets_a_window_once_from_a_slice(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "case when id % 3 = 0 then repeat('same words ', 40) else concat_ws(' ', transform(sequence(1, 40), x -> concat(id, '-', x))) end as text")
    rows = window_dedup.digests(docs)
    assert {r["n_removed"]: r["count"] for r in rows.groupBy("n_removed").count().collect()} == {80: 1334, 0: 2666}


def _ranked(texts: list[str | None], ids: list, items: list[str], k: int):
    found = [Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for t in texts]
    n, total = sum(1 for f in found if f), sum(sum(f.values()) for f in found)
    df = Counter(t for f in found for t in f)
    for item in items:
        own = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), item or ""))
        scores = []
        for i, f in zip(ids, found, strict=True):
            m = 75 + (25 * sum(f.values()) * n) // max(1, total)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * f[t]) // (1000 * f[t] + 12 * m)) for t in own if f[t])
            if score > 0:
                scores.append((-score, i is None, i))
        yield [(i, -s) for s, _, i in sorted(scores)[:k]]


@pytest.mark.parametrize(("postings", "k"), [(1 << 20, 20), (60, 20), (60, 1), (200, 500)])
def test_search_equals_brute_force(spark, monkeypatch, postings, k):
    monkeypatch.setattr(best_position, "POSTINGS", postings)
    monkeypatch.setattr(best_position, "FIRST_READ", 2)
    texts = _texts()
    docs = _docs(spark, texts)
    ids = [None if i == 40 else i // 2 if i in (50, 51) else i for i in range(len(texts))]
    items = [None, "", "no such words here qqq", "the", "of the THE alpha", texts[30], texts[31] + " " + texts[32], "人 don't", texts[20]]
    asked = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, rank string")
    got: dict = {}
    for r in sorted(best_position.search(docs, asked, k).collect(), key=lambda r: (r["item_id"], r["rank"])):
        got.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    for i, want in enumerate(_ranked(texts, ids, items, k)):
        assert got.get(i, []) == [(rank, *row) for rank, row in enumerate(want, 1)]


def test_search_stops_early_and_refuses_text_keys(spark, monkeypatch):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('common ', repeat('rare ', case when id % 600 = 0 then 50 else id % 3 end), repeat(concat('w', id % 50, ' '), cast(id % 7 as int))) as text")
    asked = spark.createDataFrame([(1, "rare common"), (1, "w7")], "item_id long, text string")
    rows = best_position.search(docs, asked, 3).collect()
    assert len(rows) == 6 and min(r["seen"] for r in rows) < 3000
    assert best_position.search(docs.limit(0), asked).count() == 0 and best_position.search(docs, asked.limit(0)).count() == 0
    with pytest.raises(TypeError):
        best_position.search(docs.selectExpr("cast(doc_id as string) as doc_id", "text"), asked)
    monkeypatch.setattr(best_position, "BLOCK_BYTES", 1)  # a block for each item
    assert sorted(map(tuple, best_position.search(docs, asked, 3).collect())) == sorted(map(tuple, rows))


def test_components_of_hard_matrices():
    rnd = np.random.default_rng(3)
    for values in ([5.0, 4, 3, 2, 1, 0.5], [1e6, 1e3, 1, 1e-3, 1e-6, 0], [2.0] * 6, [3, 3, 3, 1, 1, 1], [1, 0, 0, 0, 0, 0], [0.0] * 6, np.geomspace(1, 1e-9, 40), [7.0]):
        values = np.array(values, float)
        q, _ = np.linalg.qr(rnd.standard_normal((len(values), len(values))))
        a = q * values @ q.T
        got, vectors = whitening.components((a + a.T) / 2)
        assert np.allclose(got, np.sort(values)[::-1], atol=1e-13 * max(1e-300, values.max()) * len(values) * 4)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
        assert np.allclose(a @ vectors, vectors * got, atol=1e-12 * max(values.max(), 1e-300))
        top, _ = whitening.components((a + a.T) / 2, 2)
        assert np.allclose(top, got[:2], atol=1e-12 * max(values.max(), 1e-300))


def test_whitening_equals_numpy(spark):
    rnd = np.random.default_rng(8)
    data = rnd.standard_normal((400, 6)) * [9, 5, 2, 1, 0.5, 0.1] @ np.linalg.qr(rnd.standard_normal((6, 6)))[0] + 4000.0
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(data)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]  # copies count once in the fit
    odd = [(None, rows[1][1]), (5, rows[2][1]), (2000, None), (2001, []), (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2003, [math.nan] * 6), (2004, [math.inf] * 6), (2005, [1.0, 2.0])]
    table = spark.createDataFrame([(*r, "c") for r in rows + odd], "vec_id long, embedding array<double>, component string").repartition(7)
    got = whitening.whiten(table).collect()
    x = np.floor(data * 256).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    cov = (fit - sums / n).T @ (fit - sums / n) / n
    values, vectors = np.linalg.eigh(cov)
    assert len(got) == 4 * (len(rows) + 2) and {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9 and len({r["identity_error"] for r in got}) == 1
    for c in range(1, 5):
        e, v = values[-c], vectors[:, -c]
        own = {r["vec_id"]: r for r in got if r["component"] == c and r["vec_id"] is not None and r["vec_id"] < 400 and r["vec_id"] != 5}
        white = (x - sums / n) @ v / math.sqrt(e)
        sign = np.sign(own[7]["whitened"] * white[7])
        assert np.allclose([own[i]["whitened"] for i in sorted(own)], sign * white[sorted(own)], atol=1e-9)
        assert all(abs(r["explained"] - e / cov.trace()) < 1e-9 for r in own.values())
        assert all(r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums, strict=True)) for i, r in own.items())


def test_whitening_of_flat_and_wide_tables(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    rows = whitening.whiten(one).collect()
    assert len(rows) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in rows} == {(1, 0, None, None, None)}
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], "vec_id long, embedding array<float>")
    rows = whitening.whiten(flat).collect()
    assert {r["component"] for r in rows if r["whitened"] is not None} == {1} and {r["component"] for r in rows} == {1, 2, 3}
    wide = spark.createDataFrame([(i, [i * 1e13, 1e15 - i]) for i in range(50)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(wide, 1).collect()
    assert all(r["deviation"] is None or r["deviation"] >= 0 for r in rows) and max(r["identity_error"] for r in rows) < 1e-9
    assert whitening.whiten(one.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op11_best_position", "op13_window_dedup"])
def test_queries_equal_sql(spark, name):
    from netforensics.llm.queries import REGISTRY
    from tests.oracle_check import connect, rows_of

    folder = "/root/testdata/sf0.001"
    found, con = REGISTRY[name](spark, folder), connect(folder).execute(SQL[name])
    assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == rows_of([d[0] for d in con.description], con.fetchall())
