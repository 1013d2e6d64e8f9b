"""Prefix trie, decontamination and periodic runs against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from vacancia.llm import decontaminate, periodic, prefix_trie, queries

TURNS = "conv_id long, turn long, role string, text string, key string, shard int"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")


def conversation_rows():
    rng = random.Random(3)
    rows = [(None, 1, "user", "lost", "k", 1), (7, None, None, None, "k", 1), (7, None, None, None, "k", 1), (7, 1, "user", "é漢", "k", 1)]
    for c in range(10, 60):
        # A third begins alike and for long, some are copies, some are one turn.
        start = [("user", "hot"), ("assistant", "common")] * 3 if c % 3 == 0 else [("user", f"own {c % 7}")]
        rest = [("user", f"t{rng.randrange(3)}") for _ in range(rng.randrange(6))] if c % 4 else []
        rows += [(c, t, r, x, "k", c) for t, (r, x) in enumerate(start + rest)]
    return rows + [(90, t, "user", "long" * 50, None, None) for t in range(300)] + [(91, 1, "user", "x", None, None), (91, 1, "assistant", "x", None, None)]


def brute_nodes(rows):
    own = collections.defaultdict(list)
    for c, t, r, x, *_ in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append(((t is not None, t or 0), r, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest(), x))
    own = {c: [(r, x) for _, r, _, x in sorted(v)] for c, v in own.items()}
    nodes = collections.defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(own.get(c - c % 5, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append((c, len(seq) == d))
    children = collections.Counter(s[:-1] for s in nodes if s)
    leaves, saved = collections.Counter(), collections.Counter()
    for s, members in nodes.items():
        for d in range(len(s) + 1):
            saved[s[:d]] += (len(members) - 1) * len(s[-1][1].encode()) if s else 0
            leaves[s[:d]] += not children[s]
    least = {s: min(c for c, _ in m) for s, m in nodes.items()}

    def ends(members):
        ids = sorted(c for c, end in members if end)
        return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() if ids else None

    return sorted(
        (least[s], len(s), least[s[:-1]] if s else -1, len(m), children[s], leaves[s], saved[s], str(ends(m))) for s, m in nodes.items()
    )


@pytest.mark.parametrize("shard_turns", [1, 25, 1 << 16])
def test_prefix_trie(spark, shard_turns):
    rows = conversation_rows()
    turns = prefix_trie.turn_elements(spark.createDataFrame(rows, TURNS).repartition(3))
    got = prefix_trie.prefix_nodes(prefix_trie.spliced(turns), shard_turns).collect()
    got = sorted(tuple(-1 if r[c] is None and c == "parent_conv_id" else str(r[c]) if c == "ends" else r[c] for c in COLUMNS) for r in got)
    assert got == brute_nodes(rows)


def test_prefix_trie_of_nothing_and_of_one_turn(spark):
    nothing = prefix_trie.turn_elements(spark.createDataFrame([], TURNS))
    assert prefix_trie.prefix_nodes(prefix_trie.spliced(nothing)).count() == 0
    rows = [(1, 0, "user", "a", None, None)]
    turns = prefix_trie.turn_elements(spark.createDataFrame(rows, TURNS))
    assert prefix_trie.prefix_nodes(prefix_trie.spliced(turns)).count() == len(brute_nodes(rows))


def test_end_digests_stream_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [("a", i) for i in range(-5, 200)] + [("b", 7)]
    got = {r["sid"]: r["ends"] for r in prefix_trie.end_digests(spark.createDataFrame(rows, "sid string, conv_id long").repartition(5)).collect()}
    assert got == {s: hashlib.sha256(",".join(str(i) for n, i in rows if n == s).encode()).hexdigest() for s in "ab"}


def test_double_array_finds_children_only_where_they_are():
    rng = np.random.default_rng(5)
    sequences = sorted({tuple(rng.integers(1, 30, rng.integers(0, 8)).tolist()) for _ in range(500)})
    lengths = np.array([len(s) for s in sequences])
    trie = prefix_trie.DoubleArray(np.array([x for s in sequences for x in s], np.int64), lengths, 29)
    prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    node = {(): 0}
    for p in sorted(prefixes - {()}, key=len):
        node[p] = int(trie.base[node[p[:-1]]] + p[-1])
        assert trie.check[node[p]] == node[p[:-1]]
    assert len(set(node.values())) == len(prefixes) == (trie.check >= 0).sum() + 1


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_spans(docs, items, window):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    phrases = [(i, WORD.findall((t or "").translate(lower))) for i, t, *_ in items]
    for doc, text, *_ in docs:
        words, hit, found = WORD.findall((text or "").translate(lower)), set(), set()
        for i, phrase in phrases:
            k = min(window, len(phrase))
            wanted = {tuple(phrase[s : s + k]) for s in range(len(phrase) - k + 1)} if k else set()
            for s in range(len(words) - k + 1):
                if tuple(words[s : s + k]) in wanted:
                    hit.update(range(s, s + k))
                    found.update([] if i is None else [str(i)])
        yield doc, len(words), sorted(hit), sorted(found)


def benchmark_case():
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(4)}"
    items = [(i, " ".join(word() for _ in range(n)), "x") for i, n in enumerate([0, 1, 3, 4, 9, 30, 200])]
    items = items[:1] + items[2:] + [(50, None, "x"), (51, "  ,;", "x"), (None, "Ünique phrase of four", "x"), (4, "second text same id", "x")]
    docs = [(i, " ".join(word() if rng.random() < 0.9 else "other" for _ in range(n)), "s") for i, n in enumerate([0, 2, 3, 8, 40, 400, 3000])]
    docs += [(20, None, "s"), (21, "", "s"), (22, "an Ünique-PHRASE, of\tfour more", "s"), (22, "an Ünique-PHRASE, of\tfour more", "s"), (23, "second text same id", "s")]
    return docs, items


@pytest.mark.parametrize("shard_words,block_bytes", [(1 << 20, 1 << 23), (16, 1 << 23), (1 << 20, 300)])
def test_decontamination(spark, monkeypatch, shard_words, block_bytes):
    docs, items = benchmark_case()
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard_words)
    left = spark.createDataFrame(docs, "doc_id long, text string, key string")
    right = spark.createDataFrame(items, "item_id long, text string, words string")
    found = decontaminate.contaminated_spans(left, right, 4, block_bytes=block_bytes)
    rows = found.collect()
    got = sorted((r["doc_id"], r["n_words"], [w for s in r["spans"] for w in range(s["start"], s["end"])], list(r["items"])) for r in rows)
    assert got == sorted(brute_spans(docs, items, 4))
    assert all(a["end"] < b["start"] for r in rows for a, b in zip(r["spans"], r["spans"][1:]))
    digests = {r["doc_id"]: r for r in decontaminate.with_digests(found).collect()}
    for doc, n_words, hit, listed in brute_spans(docs, items, 4):
        r = digests[doc]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n_words, len(hit), len(listed), bool(hit))
        assert r["items_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()


def test_decontamination_of_empty_tables(spark):
    docs, items = benchmark_case()
    left = spark.createDataFrame(docs, "doc_id long, text string, key string")
    right = spark.createDataFrame(items, "item_id long, text string, words string")
    assert not any(r["spans"] or r["items"] for r in decontaminate.contaminated_spans(left, right.limit(0)).collect())
    assert decontaminate.contaminated_spans(left.limit(0), right).count() == 0


def test_benchmark_pieces_lose_no_window(spark):
    text = " ".join(f"w{i}" for i in range(1000))
    pieces = decontaminate.benchmark_pieces(spark.createDataFrame([(1, text)], "item_id long, text string"), "item_id", "text", 10, 64).collect()
    seen = {tuple(w[i : i + 10]) for p in pieces for w in [bytes(p["words"]).decode().split()] for i in range(len(w) - 9)}
    words = text.split()
    assert len(pieces) > 2 and seen == {tuple(words[i : i + 10]) for i in range(991)}


def test_spans_are_taken_out_of_texts(spark):
    rows = [("Aa bb, cc dd; ee.", [(1, 3)]), ("one", []), (None, [])]
    df = spark.createDataFrame(rows, "text string, spans array<struct<start:long,end:long>>")
    assert [r[0] for r in df.select(decontaminate.without_spans("text", "spans")).collect()] == ["Aa  dd; ee.", "one", None]


def brute_runs(words):
    out = set()
    for q in range(1, len(words) // periodic.TIMES + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            e = i + q
            if e - s >= max(periodic.LEAST, periodic.TIMES * q) and not any(
                all(words[x] == words[x + p] for x in range(s, e - p)) for p in range(1, q)
            ):
                out.add((s, e, q))
            i += 1
    return out


@pytest.mark.parametrize("codes,transform", [(1 << 19, 1 << 19), (2, 1 << 19), (1 << 19, 8)])
def test_runs_of_random_words(monkeypatch, codes, transform):
    monkeypatch.setattr(periodic, "CODES", codes)
    monkeypatch.setattr(periodic, "TRANSFORM", transform)
    rng = random.Random(codes + transform)
    for _ in range(400):
        words = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(1, 60))]
        if rng.random() < 0.6:
            words[rng.randrange(len(words)) :] = ([rng.randrange(4) for _ in range(rng.randint(1, 9))] * 20)[: rng.randint(4, 60)]
        found = periodic.find_runs(np.array(words, np.int64), len(words))
        assert set(zip(*(map(int, x) for x in found))) == brute_runs(words)


def test_transforms_are_exact():
    rng = np.random.default_rng(6)
    for b in (1, 2, 8, 64, 512):
        block, window = rng.integers(1, 1 << 18, (3, b)), rng.integers(1, 1 << 18, (3, 2 * b))
        window[0, b // 2 : b // 2 + b] = block[0]
        want = np.stack([((window[:, t : t + b] - block) ** 2).sum(1) for t in range(b)], 1)
        for sums, (p, _) in zip(periodic.mismatches(block, window, 1 << 18), periodic.PRIMES):
            assert (sums == want % p).all()
        assert want[0, b // 2] == 0


def periodic_rows():
    texts = [
        "", None, " \t\n", "a", "a a a a a", "a a a a a a", "x y  z " * 5, "one two three " * 9 + "tail", "a b " * 7 + "c " * 12,
        "\n".join(f"w{i}" for i in range(400)), "the same line of words here\n" * 300, "z " * 5000, " ".join(f"w{i % 37}" for i in range(4000)),
    ]
    return [(i, t, "s", 1) for i, t in enumerate(texts * 3)] + [(1, None, "s", 1), (None, "a a a a a a a", "s", 1)]


@pytest.mark.parametrize("slice_words", [1 << 19, 50])
def test_periodic_runs(spark, monkeypatch, slice_words):
    monkeypatch.setattr(periodic, "SLICE_WORDS", slice_words)
    rows = periodic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start int").repartition(3)
    got = {r["doc_id"]: r for r in periodic.with_digests(periodic.periodic_runs(docs, rebuild=queries.periodic_tail)).collect()}
    for doc, text, *_ in rows[:-2]:
        words = (text or "").encode().split()
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = sorted((s, e - s, q) for s, e, q in brute_runs(words))
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
        top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        r = got[doc]
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *top)
        assert r["exponent_milli"] == (1000 * top[1] // top[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(kept).hexdigest()
    assert got[None]["n_runs"] == 1
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_very_long_text_is_read_in_parts():
    part, text = periodic.Slice(), "word of a long text\n" * 150_000
    part.add(text, None)
    (runs, digest), = part.rows()
    assert runs.tolist() == [[0, 750_000, 5]] and digest == hashlib.sha256(b"word of a long text").hexdigest()


CLASH = "doc_id long, text string, source string, key string, _k string, __key string, __kept string, group_size int, row string, id int"


def clashing(rows):
    return [(d, t, s, "k", "kk", "kkk", "kkkk", 7, "r", 9) for d, t, s in rows]


def test_pipeline_against_brute_force(spark, tmp_path):
    """Planted toxic texts, exact copies and near copies go; every other text stays, mixed and encoded."""
    import corpus_pipeline
    from vacancia.llm import mixing

    rng = random.Random(11)
    plain = [f"w{i}" for i in range(400)]
    toxic = [f"vile{i}" for i in range(6)]
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        words = [rng.choice(plain) for _ in range(40)]
        if bad:
            words = [rng.choice(toxic) if rng.random() < 0.5 else w for w in words]
        rows.append((i, " ".join(words), f"s{i % 3}"))
        labels.append((i, 1, int(bad)))
    clean = [r for r in rows if r[0] % 5]
    exact = [(1000 + r[0], r[1].replace(" ", "  "), r[2]) for r in clean[:20]]
    near = [(2000 + r[0], r[1] + " tail", r[2]) for r in clean[20:40]]
    odd = [(3000, "", "s0"), (3001, None, None), (3002, "   ", "s0"), (1, rows[1][1], "s1"), (None, "no identifier here at all", "s1")]
    every = rows + exact + near + odd
    folder = str(tmp_path / "sf")
    docs = spark.createDataFrame(clashing(every), CLASH)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")

    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()}
    assert left == {d for d, _, _ in every} - {d for d, _, _ in rows if d % 5 == 0}

    once = corpus_pipeline.drop_copies(spark, kept, folder).cache()
    assert once.columns == docs.columns and once.where("__key <> 'kkk' OR group_size <> 7").count() == 0
    # Of equal texts the longest original stays.
    bare = {}
    for d, t, _ in every:
        if d in left:
            text = t or ""
            mark = "".join(text.split())
            bare[mark] = min(bare.get(mark, (1, 0)), (-len(text), d if d is not None else -1))
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in once.collect()) == sorted(d for _, d in bare.values())

    apart = corpus_pipeline.drop_near_copies(spark, once, folder).cache()
    gone = {r["doc_id"] for r in once.collect()} - {r["doc_id"] for r in apart.collect()}
    assert apart.columns == docs.columns and gone == {d for d, _, _ in near}

    mixed = corpus_pipeline.mix(spark, apart, folder).cache()
    uses = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == docs.columns and set(uses) == {r["doc_id"] for r in apart.collect()} and max(uses.values()) <= 2
    plan = mixing.mixed_rows(apart, repeat_limit=corpus_pipeline.REPEAT_LIMIT)
    assert plan.count() == mixed.count()

    out = corpus_pipeline.encode(spark, mixed, folder)
    assert out.where("NOT restored").count() == 0 and out.count() == mixed.count()


def test_huge_and_tiny_vectors_with_pivots_in_small_spaces(spark):
    from vacancia.llm import embeddings

    rng = np.random.default_rng(8)
    base = rng.normal(size=(6, 5))
    vectors = np.repeat(base, 20, axis=0) + rng.normal(size=(120, 5)) * 0.12
    scales = np.tile([1.0, 1e200, 1e-200, 1e-3], 30)
    rows = [(i, (v * s).tolist(), i % 2) for i, (v, s) in enumerate(zip(vectors, scales))] + [(500, [0.0] * 5, 0), (501, [0.0, 1e-300, 0.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    close = (unit @ unit.T >= 0.93) & (np.arange(120)[:, None] % 2 == np.arange(120)[None] % 2)
    found = {r["vec_id"]: r for r in embeddings.near_vectors(df, 0.93, per_pivot=8).collect()}
    plain = {r["vec_id"]: r for r in embeddings.near_vectors(df, 0.93).collect()}
    labels = np.arange(120)
    while True:
        new = np.where(close, labels[None], 10**9).min(1)
        if (new == labels).all():
            break
        labels = new
    for i in range(120):
        assert found[i]["n_links"] == plain[i]["n_links"] == close[i].sum() - 1
        assert found[i]["component_id"] == plain[i]["component_id"] == labels[i]
    assert found[500]["n_links"] == found[501]["n_links"] == 0
