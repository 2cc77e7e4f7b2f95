"""Merkle manifest, divergence of sources and exact dedup against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rillwork.llm import divergence, extendible, merkle

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, data):
    return spark.createDataFrame(data, DOCS).repartition(3)


# --- exact dedup ---------------------------------------------------------------


def brute_groups(data):
    """Rows of doc_id, keep_id, group_size, kept, digest."""
    groups = defaultdict(list)
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in data]
    for r, text in zip(data, plain):
        groups[text].append(r[0])
    out = []
    for r, text in zip(data, plain):
        ids = [i for i in groups[text] if i is not None]
        keep = min(ids, default=None)
        out.append((r[0], keep, len(groups[text]), r[0] == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def texts_with_copies(n, seed=4):
    draw = random.Random(seed)
    found = [None, "", " ", "\t\n", "a b", "a  b", "a\x0bb", "a b", "　", "x" * 300_000, "x" * 299_999 + "y"]
    while len(found) < n:
        found.append(draw.choice([
            "the same text in a third of all rows", f"text {draw.randrange(n)}", f"text\r\n {draw.randrange(40)}", draw.choice(found),
        ]))
    return [(i, t, "en", "s", 1) for i, t in enumerate(found)]


@pytest.mark.parametrize("capacity,crowd", [(extendible.BUCKET_BYTES, extendible.CROWD_ROWS), (40, 5)])
def test_exact_groups(spark, capacity, crowd):
    data = texts_with_copies(400)
    data += [(None, "text 1", None, None, None), (None, "alone", None, None, None), (None, "alone", None, None, None), data[20], data[20]]
    names = "key slot bucket part parts crowded digest id chain keep_id group_size kept _keep _key row"
    docs = table(spark, data).withColumns({n: F.lit("clash") for n in names.split()})
    got = extendible.groups(docs, capacity=capacity, crowd=crowd)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_groups(data)


@pytest.mark.parametrize("crowd", [3, 1000])
def test_colliding_keys_are_chained(spark, monkeypatch, crowd):
    monkeypatch.setattr(extendible, "hashed", lambda text: F.xxhash64(F.length(text)))
    data = texts_with_copies(300)
    got = extendible.groups(table(spark, data), capacity=200, crowd=crowd)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_groups(data)
    entries = extendible.build(table(spark, data), capacity=200, crowd=crowd).entries
    chains = defaultdict(list)
    for r in entries.collect():
        chains[r.key].append((r.chain, r.keep_id))
    assert max(map(len, chains.values())) > 5
    for chain in chains.values():
        assert [c for c, _ in sorted(chain)] == list(range(1, len(chain) + 1))
        assert [k for _, k in sorted(chain)] == sorted(k for _, k in chain)


def test_directory_splits_what_is_overfull(spark):
    draw = random.Random(1)
    sizes = {draw.randrange(-(1 << 63), 1 << 63): draw.randrange(1, 50) for _ in range(300)} | {5: 400}
    keys = spark.createDataFrame(list(sizes.items()), "key bigint, n_bytes bigint")
    slots = {r.slot: (r.bucket, r.depth) for r in extendible.directory(keys, 200, 12).collect()}
    held = defaultdict(list)
    for key, size in sizes.items():
        place = (key % (1 << 64)) >> 52
        bucket, depth = slots[place]
        assert bucket == (1 << depth) + (place >> (12 - depth))
        held[bucket, depth].append(size)
    assert all(sum(v) <= 200 or len(v) == 1 for v in held.values())
    parents = defaultdict(int)
    for (bucket, _), v in held.items():
        for up in range(1, bucket.bit_length()):
            parents[bucket >> up] += sum(v)
    assert all(v > 200 for v in parents.values())
    assert len({d for _, d in held}) > 2


def test_exact_dedup_keeps_one_row_with_its_columns(spark):
    data = texts_with_copies(200)
    data += [data[5], (None, "no id", "x", "y", 1), (None, "no  id", "x", "y", 1)]
    docs = table(spark, data).withColumns({n: F.lit(n) for n in ("_id", "_digest", "_row", "_i", "_d", "kept", "a.b")})
    got = extendible.keep_first(docs)
    assert got.columns == docs.columns and [r[0] for r in got.select("`a.b`").distinct().collect()] == ["a.b"]
    want = {(k, d) for i, k, _, kept, d in brute_groups(data) if kept}
    found = [(r.doc_id, hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "").encode()).hexdigest()) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == want


def test_exact_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert extendible.groups(empty).count() == 0 and extendible.keep_first(empty).count() == 0


# --- divergence ----------------------------------------------------------------


def brute_audit(data, least=10, most=10):
    docs = defaultdict(Counter)
    counts, groups = defaultdict(Counter), {(r[2] or "", r[3] or "") for r in data}
    for _, text, lang, source, _ in data:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        docs[lang or ""].update(set(terms))
        counts[lang or "", source or ""].update(terms)
    out = []
    for lang in {g for g, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = sorted(s for g, s in groups if g == lang)
        sums = {s: counts[lang, s] for s in sources}
        sums[None] = sum((counts[lang, s] for s in sources), Counter())
        total = {s: sum(c[t] for t in kept) for s, c in sums.items()}
        p = {(s, t): 1 + 10**9 * (c[t] + 2) // (total[s] + 2 * len(kept)) for s, c in sums.items() for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s, t], p[o, t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s, t], p[None, t]), t) for t in kept if sums[s][t] and p[s, t] > p[None, t]]
            for part, items, end in (("pair", pairs, None), ("term", terms, most)):
                items.sort(key=lambda v: (-v[0], v[1].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (value, item) in enumerate(items[:end])]
    return sorted(out)


def audit_texts(seed=2, n=150):
    draw = random.Random(seed)
    words = [a + b for a in "ka Lo mi NU été straße ÀB 中文 q".split() for b in "ba do fe 中 É".split()] + ["the"] * 30
    data = []
    for i in range(n):
        source = draw.choice(["hot", "hot", "b", "c", None, ""])
        some = words[: 10 + 10 * len(source or "")]
        text = draw.choice(" ,\x00\x7f1@[`{").join(draw.choice(some) for _ in range(draw.randrange(60)))
        data.append((i, draw.choice([text, text, text, None, "", "12 3"]), draw.choice(["en", "en", None, "fr"]), source, i))
    return data + [(900, "solo " * 5000, "xx", "only", 1), (901, None, "yy", "a", 1), (902, "z", "yy", "b", 1)] + data[:5]


@pytest.mark.parametrize("bits", [64, 3])
def test_audit(spark, bits):
    data = audit_texts()
    docs = table(spark, data).withColumns({n: F.lit(1) for n in "term digest n n_docs value rank item p q v total".split()})
    got = divergence.audit(docs, bits=bits)
    want = brute_audit(data)
    assert sorted(tuple(r) for r in got.collect()) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[4] for r in want)


def test_shared_digests_are_split(spark):
    sums, names = divergence.counted(table(spark, audit_texts()).fillna("", ["lang", "source"]), 2)
    found = names.collect()
    assert len({r.term for r in found if r.term}) == len(found) > 20
    whole, _ = divergence.counted(table(spark, audit_texts()).fillna("", ["lang", "source"]), 64)
    assert sums.agg(F.sum("n")).first() == whole.agg(F.sum("n")).first()


def test_terms_written_often_count_once_each(spark, monkeypatch):
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    monkeypatch.setattr(divergence, "SEEN_TERMS", 3)
    monkeypatch.setattr(divergence, "SLICE_ROWS", 2)
    data = audit_texts(seed=8, n=80)
    assert sorted(tuple(r) for r in divergence.audit(table(spark, data)).collect()) == brute_audit(data)


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


# --- manifest ------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(r):
    values = [r[0], r[3], r[2], r[4], r[1]]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def brute_levels(level):
    levels = [level]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def brute_manifest(data):
    key = lambda v: (v is not None, v if v is not None else 0)
    langs = sorted({r[2] for r in data}, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        rows = sorted((r for r in data if r[2] == lang), key=lambda r: (key(r[0]), brute_leaf(r)))
        trees[lang] = rows, brute_levels([brute_leaf(r) for r in rows])
    top = brute_levels([trees[lang][1][-1][0] for lang in langs])
    out = []
    for number, lang in enumerate(langs):
        rows, levels = trees[lang]
        for pos, r in enumerate(rows):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = brute_leaf((*r[:4], r[4] + 1)) if tampered else brute_leaf(r)
            proof = []
            for place, tree in ((pos, levels), (number, top)):
                for k, level in enumerate(tree[:-1]):
                    i = place >> k
                    run = level[i - i % 2 : i - i % 2 + 2]
                    proof += [d for j, d in enumerate(run) if j != i % 2]
                    run[i % 2] = node
                    node = sha(*run)
            root = top[-1][0]
            out.append((r[0], brute_leaf(r), levels[-1][0], root, sha(*proof), node, node == root))
    return sorted(out, key=str)


def verified(docs, **options):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    got = merkle.verify(docs, {"n_chars": F.col("n_chars") + 1}, tampered, **options)
    return sorted((tuple(r) for r in got.collect()), key=str)


def manifest_rows(n, seed=6):
    draw = random.Random(seed)
    data = [(i * 3, draw.choice(["t", "é中", None, "", "x" * 50]), draw.choice(["en"] * 5 + ["de", None, "", "é"]),
             draw.choice(["s", None]), draw.choice([i, None])) for i in range(n)]
    data += [(1, "alone", "zz", "s", 3), (2, "y" * 1_000_000, "en", "s", 3)]
    return data + data[:3] + [(0, "other", "en", "s", 7), (None, "no id", "en", None, 4), (None, None, None, None, None)]


@pytest.mark.parametrize("bits,top_nodes", [(10, 1 << 16), (2, 1 << 16), (1, 30), (2, 3)])
def test_manifest(spark, bits, top_nodes):
    data = manifest_rows(150)
    names = "id leaf altered tree n pos block level idx want digest nodes root verified _slice _place".split()
    docs = table(spark, data).withColumns({n: F.lit("clash") for n in names})
    got = verified(docs, bits=bits, top_nodes=top_nodes)
    assert got == brute_manifest(data)
    assert {r[6] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 9])
def test_small_manifests(spark, n):
    data = [(i, f"t{i}", "en", "s", i) for i in range(n)]
    assert verified(table(spark, data), bits=1) == brute_manifest(data)


def test_manifest_of_nothing(spark):
    assert verified(spark.createDataFrame([], DOCS)) == []


def test_missing_nodes_are_the_least_that_serve():
    """Each one is needed by a path, none follows from the leaves, and with them the root follows."""
    draw = random.Random(3)
    for _ in range(200):
        n = draw.randrange(1, 70)
        leaves = [f"{i}".encode() for i in range(n)]
        levels = merkle.above(dict(enumerate(leaves)), n, 0, merkle.height(n))
        chosen = draw.sample(range(n), draw.randrange(1, min(n, 6) + 1))
        places = merkle.missing(0, n, chosen)
        paths = {(k, (i >> k) ^ 1) for i in chosen for k in range(merkle.height(n)) if (i >> k) ^ 1 < merkle.width(n, k)}
        own = {(k, i >> k) for i in chosen for k in range(merkle.height(n) + 1)}
        assert len(places) == len(set(places)) and {(k, i) for _, k, i in places} == paths - own
        known = {i: leaves[i] for i in chosen}
        for k in range(merkle.height(n)):
            known |= {i: levels[k][i] for _, at, i in places if at == k}
            known = merkle.above(known, n, k, k + 1)[1]
        assert known[0] == levels[-1][0]
