"""SimHash, embeddings, repeats, shards, mixes and url filters: operators that relate rows."""

from __future__ import annotations

import hashlib
import math


import numpy as np
import pytest
import xxhash

from textloom.llm import embeddings, mixing, sharding, simhash, suffixes, url_filter
from textloom.llm.components import components


def least_reachable(near: np.ndarray, names: list) -> list:
    label = list(range(len(names)))
    for _ in names:
        label = [min([label[i], *(label[j] for j in np.flatnonzero(near[i]))]) for i in range(len(names))]
    return [names[i] for i in label]


@pytest.mark.parametrize("edges", [[], [(1, 1), (None, 2)], [(i + 1, i) for i in range(60)], [(0, i) for i in range(1, 50)] + [(7, 100), (200, 201)]])
def test_components(spark, edges):
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    pairs = [(u, v) for u, v in edges if u is not None and u != v]
    names = sorted({x for p in pairs for x in p})
    near = np.array([[(a, b) in pairs or (b, a) in pairs for b in names] for a in names], bool)
    assert got == dict(zip(names, least_reachable(near, names), strict=True))


def _fingerprint(text):
    words = (text or "").encode().lower().split()
    size = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(awkward, awkward_rows, nothing):
    got = simhash.near_duplicates(awkward).collect()
    rows = sorted(((r[0], _fingerprint(r[1])) for r in awkward_rows), key=lambda r: (r[0] is None, r[0] or 0))
    prints = np.array([f for _, f in rows], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    want = [(i, f"{f:016x}", c) for (i, f), c in zip(rows, least_reachable(near, [i for i, _ in rows]), strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert simhash.near_duplicates(nothing).count() == 0


def test_simhash_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centers = rng.integers(0, 1 << 64, 12, np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (12, 90, 2), np.uint64)
    fps = np.unique(np.concatenate(((centers[:, None] ^ flips[..., 0]).ravel(), (centers[:, None] ^ flips[..., 0] ^ flips[..., 1]).ravel(), rng.integers(0, 1 << 64, 200, np.uint64))))
    signed = [int(x) for x in fps.view(np.int64)]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = dict(map(tuple, components(simhash.links(frame)).collect()))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    order = np.argsort(signed)
    names = [signed[i] for i in order]
    want = dict(zip(names, least_reachable(near[np.ix_(order, order)], names), strict=True))
    assert {x: got.get(x, x) for x in names} == want


def test_a_full_cell_is_one_forest():
    fps = np.arange(3_000, dtype=np.uint64) << np.uint64(8)
    u, v = simhash.cell_links(fps)
    assert len(u) == len(fps) - 1 and len(np.unique(v)) == 1


@pytest.mark.parametrize("rows_of_a_block", [embeddings.BLOCK_ROWS, 7])
def test_embeddings(spark, monkeypatch, rows_of_a_block):
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", rows_of_a_block)
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(9, 16))
    vectors = np.concatenate([c + rng.normal(size=(14, 16)) * 0.06 for c in centers]).astype(np.float32)
    rows = [(i, i % 2 if i % 11 else None, [float(x) for x in v], "e") for i, v in enumerate(vectors)]
    n = len(rows)
    rows += [(n + i, 0, rows[2][2], "copy") for i in range(9)]
    rows += [(900, 0, None, "n"), (901, 0, [], "n"), (902, 0, [0.0] * 16, "n"), (903, 0, [1.0, None] * 8, "n")]
    rows += [(904, 0, [math.nan] * 16, "n"), (905, 1, [1.0, 2.0], "short"), (906, 1, [2.0, 4.0], "short"), (907, 1, [1e30] * 16, "big"), (908, 1, [1e-30] * 16, "tiny"), (909, 1, [3.0] * 16, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, key string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame).collect()}
    good = lambda v: v and None not in v and all(map(math.isfinite, v)) and any(v)

    def linked(a, b):
        if a is b or a[1] is None or a[1] != b[1] or not good(a[2]) or not good(b[2]) or len(a[2]) != len(b[2]):
            return False
        x, y = np.array(a[2]), np.array(b[2])
        return bool(x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98)

    near = np.array([[linked(a, b) for b in rows] for a in rows])
    parts = least_reachable(near, [r[0] for r in rows])
    want = {r[0]: (int(near[i].sum()), parts[i], parts[i] == r[0]) for i, r in enumerate(rows)}
    assert got == want
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def _brute_repeats(rows):
    """(kept, removed, spans) of (id, bytes) rows; windows of smaller ids only."""
    seen, out = {}, []
    for doc, text in rows:
        for i in range(len(text) - 49):
            w = text[i : i + 50]
            seen[w] = min(doc, seen.get(w, doc))
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 49):
            if seen[text[i : i + 50]] < doc:
                gone[i : i + 50] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out.append((bytes(np.frombuffer(text, np.uint8)[~gone]), int(gone.sum()), spans))
    return out


def test_repeats(awkward, awkward_rows, nothing):
    got = suffixes.remove_repeats(awkward).collect()
    rows = [(math.inf if r[0] is None else r[0], (r[1] or "").encode()) for r in awkward_rows]
    want = [
        (None if doc == math.inf else doc, len(text), gone, spans, hashlib.sha256(kept).hexdigest(), kept)
        for (doc, text), (kept, gone, spans) in zip(rows, _brute_repeats(rows), strict=True)
    ]
    show = lambda r: repr((r[0], r[1], r[2], r[3], r[4], bytes(r[5])))
    assert sorted(map(show, got)) == sorted(map(show, want))
    assert suffixes.remove_repeats(nothing).count() == 0


def test_repeats_of_one_id_with_other_texts_stay(spark):
    a, b = "abcdefghij" * 8, "klmnopqrst" * 8
    docs = spark.createDataFrame([(1, a), (1, a + b), (2, b + "!" + a), (3, "z")], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in suffixes.remove_repeats(docs, texts=False).collect())
    assert got == [(1, 80, 0), (1, 160, 0), (2, 161, 160), (3, 1, 0)]


def test_windows_are_compared_in_turns_and_never_stored(spark, monkeypatch):
    rng = np.random.default_rng(4)
    phrases = ["".join(rng.choice(list("abcd"), 70)) for _ in range(12)]
    rows = [(i, "".join(phrases[j][int(rng.integers(0, 9)) :] for j in rng.choice(12, 5))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept, store = {}, suffixes.write_and_read

    def stored(df, label):
        kept.setdefault(label, []).append(store(df, label))
        return kept[label][-1]

    monkeypatch.setattr(suffixes, "write_and_read", stored)
    monkeypatch.setattr(suffixes, "WINDOW_BYTES", 4)
    want = [(doc, gone, spans, text) for (doc, _), (text, gone, spans) in zip(rows, _brute_repeats([(d, t.encode()) for d, t in rows]), strict=True)]
    for share in (0, 6):
        kept.clear()
        monkeypatch.setattr(suffixes, "TURN_SHARE", share)
        found = suffixes.remove_repeats(docs).collect()
        assert sorted((r.doc_id, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == want
        assert (len(kept["suffix-windows"]) > 1) == (share > 0)
        outcome = kept["suffix-outcome"][0]
        assert {r.kind for r in outcome.select("kind").distinct().collect()} <= {"done", "waiting"}
        assert outcome.agg({"wide": "sum"}).first()[0] > 0


def test_a_family_of_levels_decides_as_one_array():
    rng = np.random.default_rng(8)
    base = rng.integers(97, 101, 4_000).astype(np.uint8).tobytes()
    texts = [(i, 0, b"%d" % i + base[a : a + 700] + b"#" * (i % 60)) for i, a in enumerate(rng.integers(0, 3_000, 40).tolist())]
    for order in (texts, texts[::-1]):
        family = suffixes.Family()
        for row in order:
            stay, gone = suffixes.settle(suffixes.ordered(suffixes.entries([row])))
            assert not len(gone["core"])
            family.add(stay)
            sizes = [len(x["core"]) for x in family.levels]
            assert all(a >= suffixes.LIKE * b for a, b in zip(sizes, sizes[1:], strict=False))
        parts = family.finish()
        decisions = suffixes._Decisions([suffixes._decided(p) for p in parts])
        waiting = []
        own = {}
        for doc, tag, text in texts:
            run = decisions.of(doc, tag)
            own[doc] = run
            waiting.append((doc, tag, text, suffixes.take(run, np.flatnonzero(run["marked"]))))
        windows, later = suffixes._later(suffixes._windows(waiting))
        more = suffixes._Decisions([suffixes._removed(suffixes.take(windows, np.flatnonzero(later)))])
        for (doc, tag, text), want in zip(texts, _brute_repeats([(d, t) for d, _, t in texts]), strict=True):
            run = suffixes.take(own[doc], np.flatnonzero(own[doc]["marked"] == 0))
            both = suffixes.join([run, more.of(doc, tag)])
            assert suffixes.kept_bytes(text, both["start"], both["count"]) == want


def _scanned(arrays, monkeypatch):
    """(entries that scans of levels read, decisions) when a bucket gets the arrays."""
    read, mark = [], suffixes.Family._mark
    monkeypatch.setattr(suffixes.Family, "_mark", staticmethod(lambda a, b: (read.append(len(a["core"])), mark(a, b))[1]))
    rows = [(0, 0, suffixes.pack(a)) for a in arrays]
    found = [suffixes.unpack(b.as_py(), suffixes.RUN, steps=True) for out in suffixes._scan(iter([suffixes._blobs(rows)]), 1) for b in out.column("blob")]
    monkeypatch.undo()
    return sum(read), sorted(zip(*(suffixes.join(found)[k].tolist() for k in ("doc", "tag", "start", "count", "marked")), strict=True))


def test_a_scan_reads_no_more_when_entries_come_in_more_arrays(monkeypatch):
    rng = np.random.default_rng(10)
    base = rng.integers(97, 101, 9_000).astype(np.uint8).tobytes()
    texts = [(i, 0, b"%d" % i + base[a : a + 900]) for i, a in enumerate(rng.integers(0, 8_000, 128).tolist())]
    arrays = [suffixes.settle(suffixes.ordered(suffixes.entries([t])))[0] for t in texts]
    few = [suffixes.ordered(suffixes.join(arrays[i : i + 32])) for i in range(0, 128, 32)]
    (much, one), (more, other) = _scanned(few, monkeypatch), _scanned(arrays, monkeypatch)
    assert one and one == other
    assert more <= much


def test_packed_columns_of_any_size_come_back():
    rng = np.random.default_rng(11)
    for n in (0, 1, 7, 100, 5_000):
        for steps in (False, True):
            columns = {name: rng.integers(0, 1 << 32 if kind[1] != "1" else 2, n).astype(kind) for name, kind in suffixes.RUN.items()}
            blob = suffixes.pack(columns, steps=steps)
            back = suffixes.unpack(blob, suffixes.RUN, steps=steps)
            assert suffixes.packed_rows(blob) == n
            assert all((back[k] == columns[k]).all() and back[k].dtype == columns[k].dtype for k in columns)


def test_overlapping_runs_of_copies_are_joined():
    rows = [(1, 0, 0, 10, 0), (1, 0, 5, 2, 0), (1, 0, 10, 1, 0), (1, 0, 12, 3, 0), (1, 0, 12, 3, 0), (1, 0, 30, 1, 1), (2, 0, 0, 1, 0)]
    columns = {k: np.array([r[i] for r in rows[::-1]], kind) for i, (k, kind) in enumerate(suffixes.RUN.items())}
    got = suffixes._Decisions([columns]).columns
    want = [(1, 0, 0, 11, 0), (1, 0, 12, 3, 0), (1, 0, 30, 1, 1), (2, 0, 0, 1, 0)]
    assert list(zip(*(got[k].tolist() for k in suffixes.RUN), strict=True)) == want


def test_windows_compared_in_turns_are_the_same(monkeypatch):
    rng = np.random.default_rng(12)
    one = rng.integers(0, 900, 3_000).astype(np.uint64) << np.uint64(50)
    two = (one >> np.uint64(51)).astype(np.uint32)
    place = {"doc": rng.integers(0, 40, 3_000), "tag": np.zeros(3_000, np.uint32), "start": rng.integers(0, 500, 3_000).astype(np.uint32)}
    windows = {"one": one, "two": two} | place
    least: dict = {}
    for a, b, d in zip(one.tolist(), two.tolist(), place["doc"].tolist(), strict=True):
        least[a, b] = min(d, least.get((a, b), d))
    want = {
        (d, s) for a, b, d, s in zip(*(windows[k].tolist() for k in ("one", "two", "doc", "start")), strict=True) if d > least[a, b]
    }
    for at_once in (1 << 20, 100):
        monkeypatch.setattr(suffixes, "WINDOWS", at_once)
        blobs = suffixes._blobs([(0, 0, suffixes.pack(windows, steps=True))])
        found = [suffixes.unpack(b.as_py(), suffixes.RUN, steps=True) for out in suffixes._compare(iter([blobs]), 1) for b in out.column("blob")]
        got = [(d, s + i) for f in found for d, s, n in zip(f["doc"].tolist(), f["start"].tolist(), f["count"].tolist(), strict=True) for i in range(n)]
        assert len(got) == len(set(got)) and set(got) == want


def test_pieces_of_a_long_text_have_each_window_once(monkeypatch):
    rng = np.random.default_rng(9)
    text = rng.integers(97, 123, 5_000).astype(np.uint8).tobytes()
    monkeypatch.setattr(suffixes, "PIECE", 1_000)
    suffixes._powers.cache_clear()
    found = suffixes.entries([(0, 0, text), (1, 0, text[:300])])
    covered = np.zeros((2, 5_000), int)
    for doc, start, count in zip(found["doc"], found["start"], found["count"], strict=True):
        covered[doc, start : start + count] += 1
    suffixes._powers.cache_clear()
    assert (covered[0, :4_951] == 1).all() and covered[0, 4_951:].sum() == 0
    assert (covered[1, :251] == 1).all() and covered[1, 251:].sum() == 0


def _least_capacity(sizes, shards):
    def fits(c):
        used, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                used, room = used + 1, c
            room -= s
        return used <= shards

    return next(c for c in range(-(-sum(sizes) // shards), sum(sizes) + 1) if fits(c))


@pytest.mark.parametrize("heavy", [False, True])
def test_minimax_cuts(spark, monkeypatch, heavy):
    monkeypatch.setattr(sharding, "FIRST_BITS", 3)
    monkeypatch.setattr(sharding, "MORE_BITS", 2)
    rng = np.random.default_rng(6)
    h = np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, 300))
    sizes = rng.integers(8, 400, len(h))
    if heavy:
        sizes[100] = sizes.sum() // 3
    groups = spark.createDataFrame(list(zip(h.tolist(), sizes.tolist(), strict=True)), "h long, size long")
    order = np.argsort(h.view(np.uint64))
    for shards in (1, 5, 24):
        capacity, cuts = sharding.minimax_cuts(groups, shards)
        assert capacity == _least_capacity(sizes[order].tolist(), shards)
        at = np.searchsorted(np.array(cuts[: len([c for c in cuts if c < 1 << 64])], np.uint64), h.view(np.uint64), side="right")
        assert np.bincount(at, sizes).max() <= capacity


def test_shards(awkward, awkward_rows, nothing):
    out = sharding.shard_documents(awkward, 4)
    rows = out.collect()
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert len(rows) == len(awkward_rows)
    assert sorted(r.size for r in rows) == sorted(len((r[1] or "").encode()) + 8 for r in awkward_rows)
    for s in range(4):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))
    shards = {}
    for r in rows:
        shards.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    assert sharding.shard_documents(nothing).count() == 0


def test_mix(awkward, awkward_rows, nothing):
    levels, weights = ("lang", "source"), {"lang": {"en": 3, "de": 1}, "source": {"src1": 0}}
    rows = mixing.mix(awkward, levels, weights, share=0.4, epochs=3, seed=5).collect()
    assert len(rows) == len(awkward_rows)
    words = lambda t: len((t or "").encode().split())
    assert sorted(r.tokens for r in rows) == sorted(words(r[1]) for r in awkward_rows)
    taken = {}
    for r in rows:
        leaf = taken.setdefault((r.lang, r.source), [0, 0, r.budget])
        leaf[0] += r.tokens * r.copies
        leaf[1] += r.tokens
    assert all(used <= budget for used, _, budget in taken.values())
    assert all(budget <= 3 * supply for _, supply, budget in taken.values())
    assert all(b == 0 for (_, source), (_, _, b) in taken.items() if source == "src1")
    assert mixing.mix(nothing, levels, weights).count() == 0


def test_shortages_go_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 1_000), ("b", "x", 1_000), ("b", "y", 1_000), ("c", "x", 40)],
        "domain string, source string, tokens long",
    )
    got = mixing.leaf_budgets(leaves, ("domain", "source"), {}, share=900 / 3050, epochs=1)
    # c cannot use 300, so a and b share 860; a's x cannot use its half, so a's y has the rest.
    want = {("a", "x"): 10, ("a", "y"): 420, ("b", "x"): 215, ("b", "y"): 215, ("c", "x"): 40}
    assert {(r.domain, r.source): r.budget for r in got.collect()} == want


@pytest.mark.parametrize("seed", range(4))
def test_cascade_is_exact(spark, seed):
    keys = [f"host{i}.example" for i in range(3_000)]
    listed = set(keys[seed :: 7 + seed * 40])
    universe = spark.createDataFrame([(k, k in listed) for k in keys], "key string, listed boolean")
    cascade = url_filter.build_cascade(universe)
    marked = universe.withColumn("hit", cascade.contains(universe.key))
    assert marked.where("hit <> listed").count() == 0 and len(cascade.levels) > 1


def test_cascade_edges(spark, monkeypatch):
    none = spark.createDataFrame([("a", False), ("b", False)], "key string, listed boolean")
    assert none.where(url_filter.build_cascade(none).contains(none.key)).count() == 0
    monkeypatch.setattr(url_filter, "MAX_WORDS", 1)
    many = spark.createDataFrame([(f"k{i}", i % 2 == 0) for i in range(100)], "key string, listed boolean")
    marked = url_filter.mark_listed(many.withColumn("x", many.key), {"hit": many.key}, many)
    assert marked.where("hit <> listed").count() == 0 and marked.count() == 100


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/x?y#z", "https://net/", "http://net", "ftp://m.example.com/de/", "//org/fr/", "x://a.org/fr/b", None, "", "http://bad.biz/p", "https://bad.biz:1/", "http://notexample.com/de/"]
    pages = spark.createDataFrame([(i, u, "v") for i, u in enumerate(urls)] + [(1, urls[1], "v")], "page_id long, url string, verdict string")
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    blocked = spark.createDataFrame([("bad.biz",)], "key string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules, blocked).collect()}
    assert got[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[1] == ("net", "/", "net/", "block") and got[2] == ("net", "", None, "allow")
    assert got[3][2:] == ("example.com/de/", "block") and got[4] == ("", "", None, "allow")
    assert got[5][2:] == ("org/fr/", "allow") and got[6] == got[7] == ("", "", None, "allow")
    assert got[8][3] == "block" and got[9][3] == "allow" and got[10][2] is None
    assert url_filter.filter_urls(pages.limit(0), rules, blocked.limit(0)).count() == 0
    assert url_filter.filter_urls(pages, rules, blocked).count() == len(urls) + 1


def test_a_list_of_several_cascades_joins_nothing(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_WORDS", 8)
    rows = [(f"k{i}", f"k{i + 1}", i % 3 == 0, i) for i in range(400)] + [(None, "k3", False, -1), ("k0", None, True, -2)]
    df = spark.createDataFrame(rows, "a string, b string, want boolean, part int")
    universe = spark.createDataFrame([(f"k{i}", i % 3 == 0) for i in range(401)], "key string, listed boolean")
    assert url_filter.parts_needed(universe) > 2
    got = url_filter.mark_listed(df, {"a": df.a, "hit": df.b}, universe)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString() and got.columns == ["a", "b", "want", "part", "hit"]
    for r in got.collect():
        assert r.a == r.want and r.hit == (r.b is not None and int(r.b[1:]) % 3 == 0)
    assert got.count() == len(rows)


def test_url_helper_columns_do_not_clash(spark):
    pages = spark.createDataFrame([(1, "http://x.net/p", 5, "kept")], "page_id long, url string, _listed int, _key_1_1 string")
    pages = pages.withColumn("_best", pages.page_id)
    blocked = spark.createDataFrame([("x.net",)], "key string")
    got = url_filter.filter_urls(pages, {"org/": "block"}, blocked).first()
    assert (got["_listed"], got["_key_1_1"], got["_best"], got.verdict) == (5, "kept", 1, "block")
