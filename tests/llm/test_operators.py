"""Every operator against a brute-force version on small tables with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from netforensics.llm import bpe_codec, kneser_ney, merkle, minhash_join, packing, quality_rules, suffix_dedup, token_counts, warc, weak_quality
from netforensics.llm.common import tokenizer_path
from netforensics.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, spans int, marks string"


def _texts():
    rnd = random.Random(11)
    words = ["alpha", "Beta,", "gamma's", "delta!!", "é", "L'été", "12", "x<|endoftext|>y", "zzz", "İstanbul", "人", "%%%"]
    line = " ".join(rnd.choice(words) for _ in range(60))
    base = " ".join(rnd.choice(words) + str(rnd.randint(0, 99)) for _ in range(120))
    near = base.split(" ")
    near[60] = "changed"
    texts = [None, "", " ", "\n\n", "one", "one two three", line, line, base, base, " ".join(near), base + " " + line, "a" * 700]
    texts += ["ab " * 300, line + "\n" + line + "\n\n" + base, "\x1ca\x1d b", "Oneded " * 200, " ".join(f"w{i}" for i in range(9000))]
    return texts + [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 90))) + ".\nEnd. Next!" for _ in range(30)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 3}", i, "clash", i, "m") for i, t in enumerate(_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer_path())
    found.no_truncation()
    found.no_padding()
    return found


def test_bpe_equals_library(docs, empty, library):
    path = tokenizer_path()
    got = _by_id(bpe_codec.digests(docs, path))
    coded = _by_id(bpe_codec.decode(bpe_codec.encode(docs, path), path))
    for i, text in enumerate(_texts()):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
        assert list(coded[i]["ids"]) == ids and coded[i]["decoded"] == decoded
    assert bpe_codec.digests(empty, path).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts_in_small_chunks(docs, empty, name):
    path = tokenizer_path(name)
    got = _by_id(token_counts.token_counts(docs, path, chunk=64, overlap=16))
    whole = _by_id(token_counts.token_counts(docs, path))
    for i, text in enumerate(_texts()):
        assert got[i]["n_tokens"] == whole[i]["n_tokens"] and got[i]["n_bytes"] == len((text or "").encode())
        assert got[i]["over_limit"] == (got[i]["n_tokens"] > 2048)
    assert token_counts.token_counts(empty, path).count() == 0


def test_packing_is_gapless_and_within_limits(docs, empty, library):
    limit = packing.Capacity(tokens=256, documents=5, cost=256 * 256, rule="dot")
    rows = packing.pack(docs, tokenizer_path(), limit).collect()
    texts = _texts()
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append(r)
    for i, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 256))
        for r in own:
            part = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
            assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"]
    for own in bins.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:k]) for k in range(len(own))]
        assert sum(r["length"] for r in own) <= 256 and len(own) <= 5 and sum(r["length"] ** 2 for r in own) <= 256 * 256
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_quality_rules(docs, empty):
    got = _by_id(quality_rules.quality_rules(docs))
    for i, text in enumerate(_texts()):
        text = text or ""
        words = text.encode().split()
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        covered = {k + d for k, w in enumerate(zip(words, words[1:], words[2:], strict=False)) if windows[w] > 1 for d in range(3)}
        lines = [x for x in text.split("\n") if x.encode().split()]
        row = got[i]
        assert (row["n_words"], row["n_repeat_words"], row["n_dup_lines"]) == (len(words), len(covered), len(lines) - len(set(lines)))
        assert row["word_chars"] == sum(len(w.decode()) for w in words) and row["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        assert row["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (row["base_failed"] and row["kept"])
    assert quality_rules.quality_rules(empty).count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_bad_hosts_are_rejected_and_small_ones_are_not(spark):
    good = " ".join(f"word{i}" for i in range(80))
    rows = [(i, "bad", "x" if i % 10 else good) for i in range(300)] + [(1000 + i, f"h{i % 20}", good) for i in range(600)] + [(5000, "tiny", "x"), (5001, "tiny", good)]
    got = _by_id(quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, source string, text string")))
    assert not got[0]["kept"] and got[0]["host_short"] > 0.5
    assert got[5001]["kept"] and all(got[1000 + i]["kept"] for i in range(600))


def test_weak_classifier_separates_junk(spark, empty):
    rnd = random.Random(2)
    syllables = ["ta", "lo", "mi", "ren", "gos", "ve", "du"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))
    rows = []
    for i in range(600):
        text = " ".join(rnd.choice(["the", "of", "and", "to"]) if rnd.random() < 0.3 else word() for _ in range(80)) + "."
        if i % 6 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        elif i % 6 == 1:
            text = " ".join([word()] * 60)
        rows.append((i, text))
    rows += [(600, None), (601, "")]
    got = _by_id(weak_quality.classify(spark.createDataFrame(rows, "doc_id long, text string")))
    right = sum(got[i]["kept"] == (i % 6 > 1) for i in range(600))
    assert right > 590 and not got[600]["kept"] and not got[601]["kept"]
    assert weak_quality.classify(empty).count() == 0


def test_near_duplicates_equal_brute_force(docs, empty):
    got = _by_id(minhash_join.near_duplicates(docs, width=4))
    sets = []
    for text in _texts():
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    label = list(range(len(sets)))
    for _ in sets:
        for i in range(len(sets)):
            for j in range(i):
                if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    label[i] = label[j] = min(label[i], label[j])
    assert [got[i]["component_id"] for i in range(len(sets))] == label
    assert [got[i]["n_shingles"] for i in range(len(sets))] == list(map(len, sets))
    assert minhash_join.near_duplicates(empty).count() == 0
    kept = minhash_join.keep_one(docs, width=4)
    assert kept.columns == docs.columns and kept.count() == len(set(label))


def test_components_of_a_long_chain(spark):
    links = spark.range(1, 300).selectExpr("id a", "id - 1 b").union(spark.createDataFrame([(901, 900)], "a long, b long"))
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert {got[i] for i in range(300)} == {0} and got[901] == got[900] == 900


def test_suffix_rows_are_the_sorted_suffixes():
    rnd = random.Random(3)
    for trial in range(30):
        strings = ["".join(rnd.choice("ab" + "cd" * (trial % 3)) for _ in range(rnd.randint(0, 30))).encode() for _ in range(rnd.randint(1, 9))]
        string, size, common = suffix_dedup.suffix_rows(np.frombuffer(b"".join(strings), np.uint8), np.cumsum([len(s) for s in strings]))
        ranked = sorted((list(s[len(s) - k :]) + [j - 1000], j, k) for j, s in enumerate(strings) for k in range(len(s) + 1))
        assert [(j, k) for _, j, k in ranked] == list(zip(string.tolist(), size.tolist(), strict=True))
        for i in range(1, len(ranked)):
            a, b = ranked[i - 1][0], ranked[i][0]
            assert common[i] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def test_suffix_dedup_equals_brute_force(docs, empty):
    got = _by_id(suffix_dedup.repeats_report(docs))
    seen = set()
    for i, text in enumerate(_texts()):
        data = (text or "").encode()
        cut = bytearray(len(data))
        for p in range(len(data) - 99):
            if (part := data[p : p + 100]) in seen:
                cut[p : p + 100] = b"\1" * 100
            seen.add(part)
        kept = bytes(b for b, c in zip(data, cut, strict=True) if not c)
        row = got[i]
        assert (row["n_bytes"], row["n_removed"]) == (len(data), sum(cut))
        assert row["n_spans"] == bytes(cut).replace(b"\0\1", b"\0S").count(b"S") + (cut[:1] == b"\1")
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    assert suffix_dedup.repeats_report(empty).count() == 0
    cut = suffix_dedup.remove_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count() and cut.where("text is null").count() == 1


def test_warc_round_trip(spark, tmp_path):
    page = "<p>" + "é" * 80 + "</p>"
    rows = [(1, "http://a/ b", page), (2, None, page), (3, "http://c", None), (4, "http://d", "short"), (5, "http://e", "short"), (6, "http://f", page + "x")]
    captures = warc.with_revisits(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id", "html")
    paths = spark.createDataFrame(warc.write(captures, f"{tmp_path}/w", "page_id", "url", "html").collect())
    nested = warc.transactions(warc.read(paths)).select(warc.note("metadata", "capture-key").cast("long").alias("k"), "*")
    got = {r["k"]: r for r in nested.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    for key, _, html in rows:
        data = (html or "").encode()
        row = got[key]["response"]
        assert (row["payload_bytes"], row["payload_digest"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert row["kind"] == ("revisit" if key == 2 else "response") and (key == 2 or bytes(row["payload"]) == data)
        assert got[key]["request"]["fields"].startswith("GET ")
    assert got[2]["response"]["refers_to"] == got[1]["capture_id"]


def test_kneser_ney_is_a_distribution_and_beats_the_base(docs, empty, spark):
    model = kneser_ney.train(docs)
    got = _by_id(kneser_ney.score(docs, model))
    texts = {i: [*(t or "").encode().lower().split(), None] for i, t in enumerate(_texts())}
    counts = Counter(w for i, ws in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    for i, ws in texts.items():
        assert (got[i]["n_tokens"], got[i]["train_tokens"], got[i]["n_known"]) == (len(ws), total, sum(counts[w] > 0 for w in ws))
        assert got[i]["base_score"] == pytest.approx(sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws))
    # The probabilities of all known words and an unknown one add up to 1 after any history.
    hashes = [kneser_ney.HASHES[w] if w is not None else int(kneser_ney.FINISH) for w in counts] + [12345]
    for history in (int(kneser_ney.BEGIN), hashes[0], 999):
        p, _ = kneser_ney.probabilities(model, np.full(len(hashes), history, np.uint64), np.array(hashes, np.uint64))
        assert p.sum() == pytest.approx(1.0)
    seen = [r for r in got.values() if not r["held_out"]]
    assert sum(r["score"] for r in seen) > sum(r["base_score"] for r in seen)
    assert kneser_ney.score(empty, kneser_ney.train(empty)).count() == 0


def test_merkle_edits(docs, empty):
    got = _by_id(merkle.edit_report(docs))
    marks = _by_id(merkle.fingerprints(docs))
    texts = [t or "" for t in _texts()]
    for i, own in enumerate(texts):
        following = texts[i - 1]  # descending keys; before 0 comes the last one
        new = own[: len(own) - len(own) // 3] + following[: len(own) // 3]
        row = got[i]
        assert row["n_chars"] == len(own) and row["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert row["fingerprint"] == marks[i]["fingerprint"] == merkle.fingerprint(own) and row["edited_fingerprint"] == merkle.fingerprint(new)
        assert (row["near_edited"] == 1.0) == (own == new) and (row["near_next"] == 1.0) == (own == following)
    assert merkle.edit_report(empty).count() == 0


def test_long_texts_do_not_make_short_ones_forgotten(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    # More distinct words than a worker remembers, in one slice, behind a text that is cut into chunks.
    many = [" ".join(f"q{i:x}" for i in range(12_000))]
    many += [" ".join(f"w{k:x}" for k in range(i, i + 6_000)) for i in range(0, 330_000, 6_000)]
    docs = spark.createDataFrame(list(enumerate(many)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, tokenizer_path()).collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(many)}


def test_a_hot_list_of_unlike_texts_does_not_grow_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(minhash_join, "BLOCK", 10)
    monkeypatch.setattr(minhash_join, "HOT", 40)
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    texts = [passage + [f"d{k}w{i}" for i in range(rnd.randint(35, 55))] for k in range(300)]
    texts += [[*t[:-5], *(f"x{i}" for i in range(5))] for t in texts[:20]]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {k: set(minhash_join.shingles(t, 4).tolist()) for k, t in rows}
    marks = {k: minhash_join.signature(minhash_join.shingles(t, 4))[1].tobytes() for k, t in rows}
    posts = spark.createDataFrame(
        [(7, k, len(sets[k]), marks[k], k, [7]) for k in sets], "key long, cid long, n long, marks binary, comp long, posted array<long>"
    )
    source = docs.withColumnRenamed("doc_id", "key")
    links = {(r["a"], r["b"]) for r in minhash_join._cross_links(posts, source, 4, 80).collect()}
    pairs = [(a, b) for a in sets for b in sets if b < a]
    assert links == {(a, b) for a, b in pairs if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8} and len(links) == 20
    cells = minhash_join._cells(posts, source, 4, 80)
    assert cells.groupBy("key", "block", "other").count().agg({"count": "max"}).first()[0] <= 40  # the passage makes no cell
    heads = minhash_join._heads(posts)
    assert heads.count() == len(rows) and heads.groupBy("key", "block").count().agg({"count": "max"}).first()[0] <= 40


def test_prefixes_of_like_sets_meet():
    rnd = np.random.default_rng(3)
    counts = rnd.integers(1, 9, minhash_join.SLOTS)
    for _ in range(300):
        size = int(rnd.integers(1, 150))
        base = rnd.integers(0, 1 << 63, size + 40, dtype=np.uint64)
        a, b = np.unique(base[:size]), np.unique(base[int(rnd.integers(0, size // 9 + 1)) : size + int(rnd.integers(0, size // 9 + 1))])
        both = len(np.intersect1d(a, b))
        if 100 * both >= 80 * (len(a) + len(b) - both):
            met = [{(k, side) for keys, side in minhash_join.prefixes(s, counts, 80) for k in keys.tolist()} for s in (a, b)]
            assert any((k, 2 if h == 2 else 1 - h) in met[1] for k, h in met[0])


def test_warc_null_keys_come_back(spark, tmp_path):
    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame([(None, "http://a", "x" * 200), (1, "http://b", "x" * 200), (None, None, None), (None, "http://a", "x" * 200), (2, "http://c", "y")], schema)
    captures = warc.with_revisits(pages, "page_id", "html")
    paths = warc.write(captures, str(tmp_path / "warc"), "page_id", "url", "html")
    rows = warc.read(spark.createDataFrame(paths.collect(), "path string, records long, bytes long"), with_payload=False)
    ids = [r["record_id"] for r in rows.where("kind <> 'warcinfo'").collect()]
    assert len(ids) == len(set(ids)) == 15
    back = warc.transactions(rows).select(warc.note("metadata", "capture-key").cast("long").alias("k"), "response.payload_bytes", "response.kind").collect()
    assert sorted(map(tuple, back), key=repr) == sorted([(None, 200, "response"), (None, 200, "response"), (1, 200, "response"), (None, 0, "response"), (2, 1, "response")], key=repr)


def test_weak_classifier_draws_distinct_texts(spark):
    rows = [(i, "same text again") for i in range(500)] + [(1000 + i, f"text number {i} of some") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for sample in (5, 40, 100):
        drawn = [r["text"] for r in weak_quality.drawn(docs, sample).collect()]
        assert len(drawn) == len(set(drawn)) == min(sample, 41)


def test_merkle_ends_are_filtered_before_they_meet(docs):
    plan = merkle.edit_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" not in plan


def test_an_anchor_with_many_neighbours_is_not_one_collection(spark, monkeypatch):
    whole = suffix_dedup.repeated

    def small(keys, starts, ends, symbols, length):
        assert len(ends) <= 24, "one collection for a whole anchor"
        return whole(keys, starts, ends, symbols, length)

    monkeypatch.setattr(suffix_dedup, "repeated", small)
    monkeypatch.setattr(suffix_dedup, "HOT", 12, raising=False)
    monkeypatch.setattr(suffix_dedup, "BATCH", 1)
    rnd = random.Random(8)
    noise = lambda n: "".join(rnd.choice("abcdefghij klm") for _ in range(n))
    line = noise(80)
    texts = [noise(90) + line + noise(90) for _ in range(60)]
    texts += [texts[3][:200] + noise(50), noise(30) + texts[7][60:190], texts[9], texts[9], line + line + line]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = _by_id(suffix_dedup.repeats_report(docs))
    seen = set()
    for i, text in enumerate(texts):
        cut = bytearray(len(text))
        for p in range(len(text) - 99):
            if (part := text[p : p + 100]) in seen:
                cut[p : p + 100] = b"\1" * 100
            seen.add(part)
        kept = "".join(b for b, c in zip(text, cut, strict=True) if not c)
        assert (got[i]["n_removed"], got[i]["kept_sha256"]) == (sum(cut), hashlib.sha256(kept.encode()).hexdigest())


def test_names_and_keys_of_the_input(spark):
    """Clashing names, repeated rows, null keys, texts of white space, keys that are not numbers."""
    base = " ".join(f"word{i}" for i in range(80))
    rows = [(1, base, "h", 1, 2), (1, base, "h", 1, 2), (2, base + " more", "h", 1, 2), (None, base, "h", 1, 2), (3, "\n\t\n", "h", 1, 2), (4, " \x1c\u2003", None, 1, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _gone int, _host int")
    kept = minhash_join.keep_one(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "3", "4", "None"]
    assert quality_rules.keep_good(docs).columns == docs.columns
    assert {r["doc_id"]: r["kept"] for r in weak_quality.classify(docs).collect() if r["doc_id"] in (3, 4)} == {3: False, 4: False}
    with pytest.raises(TypeError):
        minhash_join.near_duplicates(docs.selectExpr("cast(doc_id as string) as doc_id", "text"))


def test_many_copies_of_one_partner(spark):
    """More near copies of one text than a part of its pairs holds: all of them are one component."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:k] + [f"x{i}"] + words[k:])) for i, k in ((i, i % 200) for i in range(400))]
    got = minhash_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def test_merkle_likeness_equals_brute_force(docs):
    """The likeness settled by levels is that of the multisets of leaves, but for 1 only with equal roots."""
    texts = [t or "" for t in _texts()]
    leaves = [Counter(leaf for section in merkle.tree(t) for paragraph in section for leaf in paragraph) for t in texts]
    got = _by_id(merkle.edit_report(docs))
    order = sorted(range(len(texts)), reverse=True)
    for place, i in enumerate(order):
        following = order[(place + 1) % len(order)]
        new = merkle.edited(texts[i], texts[following])
        own = Counter(leaf for section in merkle.tree(new) for paragraph in section for leaf in paragraph)
        for name, other, text in (("near_edited", own, new), ("near_next", leaves[following], texts[following])):
            shared = sum((leaves[i] & other).values())
            want = 1.0 if text == texts[i] else min(2 * shared / (sum(leaves[i].values()) + sum(other.values())), 1 - 1e-6)
            assert abs(got[i][name] - want) < 1e-12
