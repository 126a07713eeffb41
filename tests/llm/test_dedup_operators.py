"""Line dedup, near-dedup, decontamination, sharding and the pipeline against brute force."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from assayflow.llm import common, decontaminate, embedding_dedup, line_dedup, near_dedup, packing, queries, sharding

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    df, expected = queries.queries()[name](spark, SF), con.sql(queries.oracle_sql()[name])
    a, b = df.columns, expected.columns
    assert sorted(a) == sorted(b)
    assert sorted(repr([r[c] for c in sorted(a)]) for r in df.collect()) == sorted(repr([r[b.index(c)] for c in sorted(b)]) for r in expected.fetchall())


def test_native_operators_run_no_python(spark, monkeypatch):
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return common.checkpointed(df)

    monkeypatch.setattr(decontaminate, "checkpointed", noted)
    for name in ("op3_chat_formatting", "op9_benchmark_decontamination", "op10_sharding"):
        plans.append(queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 6
    assert not [p for p in plans if re.search("Python|Pandas|Arrow|ExternalRDD", p)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 15)), min_size=1, max_size=25))
def test_components(spark, edges):
    root = {v: v for e in edges for v in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.id: r.label for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: r for v, r in root.items() if any(v in e and e[0] != e[1] for e in edges)}


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def noisy_copies(seed, groups=6, copies=14):
    """Groups of copies with edits up to the threshold and beyond, so that links chain."""
    r = random.Random(seed)
    docs = []
    for _ in range(groups):
        base = [f"w{r.randrange(900)}" for _ in range(r.choice([4, 12, 60, 200]))]
        for _ in range(copies):
            text = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4, 8])):
                text[r.randrange(len(text))] = f"e{r.randrange(10**6)}"
            docs.append((" \t" if r.random() < 0.2 else " ").join(text).upper() if r.random() < 0.1 else " ".join(text))
    r.shuffle(docs)
    return list(enumerate([*docs, "", None, "  ", "one", "ONE", "two words", "\u00a0nbsp is a letter here"]))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    docs = noisy_copies(seed)
    found = near_dedup.near_duplicates(spark.createDataFrame([(i, t, i) for i, t in docs], "doc_id long, text string, h int")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found) and len(found) == len(docs)


def test_near_duplicates_of_odd_rows(spark):
    kind = "doc_id long, text string"
    assert near_dedup.near_duplicates(spark.createDataFrame([], kind)).count() == 0
    rows = near_dedup.near_duplicates(spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (5, "A b c d e f"), (7, "x " * 60_000)], kind)).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows if r.doc_id) == [(3, 3, True), (3, 3, True), (5, 3, False), (7, 7, True)]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)]


def test_near_duplicates_of_repeated_ids(spark):
    a, b, c = ("one two three four five six", "seven eight nine ten eleven twelve", "x y z u v w")
    rows = [(3, a), (7, a), (7, b), (9, b), (9, c), (11, c.upper()), (12, "some other words than these"), (7, ""), (7, None)]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found if r.n_shingles) == [(3, 3, True), (7, 3, False), (7, 3, False), (9, 3, False), (9, 3, False), (11, 3, False), (12, 12, True)]
    assert [(r.doc_id, r.component_id) for r in found if not r.n_shingles] == [(7, 7)] * 2


def test_heavy_keys_are_joined_apart(spark, monkeypatch):
    """With a tiny bound on broadcasts every join takes the way of large inputs."""
    monkeypatch.setattr(common, "BROADCAST_KEYS", 1)
    monkeypatch.setattr(common, "HEAVY", 3)
    docs = noisy_copies(5, groups=1, copies=45)
    found = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(docs)


def test_cluster_needs_a_shared_checkpoint_folder(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.ensure_checkpoint_dir(Session())


def test_sketches_merge_and_estimate(spark):
    r = np.random.default_rng(0)
    a, b = (np.unique(r.integers(0, 2**63, 400, dtype=np.uint64)) for _ in range(2))
    merged = near_dedup.sketch([np.union1d(a, b)])
    assert (np.maximum(near_dedup.sketch([a]), near_dedup.sketch([b])) == merged).all()
    similar = np.concatenate([a[:350], b[:50]])
    x, y = near_dedup.sketch([a]), near_dedup.sketch([similar])
    n = np.array([400.0])
    assert near_dedup.may_link(n, n, x, y, 350 / 450)[0] and not near_dedup.may_link(n, n, near_dedup.sketch([a]), near_dedup.sketch([b]), 0.75)[0]


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_LINES, 0])
def test_line_dedup_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", limit)
    r = random.Random(4)
    rows = []
    for i in range(120):
        host = r.choice(["h0", "h0", "h1", "small", None])
        lines = [f"own {i} {k}" for k in range(3)] + (["footer"] if r.random() < 0.7 else []) + ["  ", ""]
        r.shuffle(lines)
        rows.append((i, host, "\n".join(lines) if r.random() < 0.95 else r.choice([None, ""]), "x"))
    rows += [(999, "h0", "only here\nfooter ", "x")] * 3
    df = spark.createDataFrame(rows, "page_id int, site string, body string, text string")
    got = line_dedup.drop_boilerplate(df, F.col("site"), "body", ratio=0.3, min_pages=4).collect()
    pages = defaultdict(set)
    for _, host, body, _ in rows:
        if body is not None:
            pages[host].add(body)
    count = Counter((h, line) for h, bodies in pages.items() for b in bodies for line in {x.strip(" \t\r") for x in b.split("\n")} if line)
    bad = {k for k, n in count.items() if n >= 4 and n > 0.3 * len(pages[k[0]])}
    assert bad and len(got) == len(rows)
    want = Counter((i, None if b is None else "\n".join(x for x in b.split("\n") if (h, x.strip(" \t\r")) not in bad)) for i, h, b, _ in rows)
    assert Counter((g.page_id, g.body) for g in got) == want
    assert line_dedup.drop_boilerplate(df.limit(0), F.col("site"), "body").count() == 0
    clash = df.limit(3).selectExpr("page_id AS host", "site AS row", "body AS text", "text AS boiler", "1 AS page", "2 AS `n.x`", "3 AS LINES")
    found = line_dedup.drop_boilerplate(clash, F.col("row"))
    assert found.columns == ["host", "row", "text", "boiler", "page", "n.x", "lines"]
    assert sorted((x.host, x.row, x.boiler, x["n.x"]) for x in found.collect()) == sorted((x.host, x.row, x.boiler, x["n.x"]) for x in clash.collect())


def test_decontamination_finds_scattered_and_short_items(spark):
    r = random.Random(9)
    item = [f"t{k}" for k in range(40)]
    noise = lambda n: " ".join(f"n{r.randrange(10**6)}" for _ in range(n))
    docs = [
        (1, noise(3000) + " " + " ".join(item).upper().replace("T3 ", "t3, ") + " " + noise(2000)), (2, noise(50) + " " + " ".join(item[:36])), (3, " ".join(item[:25])), (4, None), (5, ""), (6, noise(20)), (None, " ".join(item)), (1, " ".join(item)),
    ]
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, item_id int")
    b = spark.createDataFrame([(7, " ".join(item)), (7, " ".join(item)), (8, "too few words"), (9, None), (10, "?!")], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.item_id, r.n_item, r.n_shared) for r in decontaminate.find(d, b).collect()) == [(0, 7, 36, 36), (1, 7, 36, 36), (2, 7, 36, 32)]
    assert decontaminate.find(d, b.limit(0)).count() == 0 and decontaminate.find(d.limit(0), b).count() == 0
    assert sorted(str(r.doc_id) for r in decontaminate.remove_contaminated(d, b).collect()) == ["3", "4", "5", "6"]
    clash = d.selectExpr("doc_id AS item", "text", "doc_id AS text_key", "1 AS h")
    left = decontaminate.remove_contaminated(clash, b)
    assert left.columns == clash.columns and left.count() == 4


def runs(text, width):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute_contained(docs, items, threshold=0.75):
    """By id: the shingles of an item are those of all its rows, the shorter ones whole."""
    shingled, out = defaultdict(set), set()
    for i, text in items:
        n = len(re.findall(r"[^\W_]+", (text or "").lower()))
        shingled[i] |= runs(text, min(n, 5)) if n else set()
    for d in {d for d, _ in docs}:
        own = {k: set().union(*(runs(t, k) for x, t in docs if x == d)) for k in range(1, 6)}
        for i, s in shingled.items():
            n = sum(x in own[len(x)] for x in s)
            if s and n >= threshold * len(s):
                out.add((d, i, len(s), n))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_decontamination_equals_brute_force(spark, seed):
    """Items of 1 to 300 words, documents with runs and scattered parts of them at, above and below the threshold."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    items = [(k, " ".join(word() for _ in range(r.choice([1, 2, 3, 4, 5, 6, 8, 12, 40, 300])))) for k in range(30)]
    items += [(0, items[5][1]), (None, items[6][1] + " x"), (None, "only here"), (31, "Paris is the capital"), (32, None)]
    docs = []
    for k in range(60):
        parts = [" ".join(word() for _ in range(r.randrange(40)))]
        for _ in range(r.randrange(4)):
            w = r.choice(items[:-1])[1].split()
            cut = r.choice([0, 0, len(w) // 8, len(w) // 5, len(w) // 4, len(w) // 3])
            at = r.randrange(len(w) + 1)
            parts += [" ".join(w[cut:] if r.random() < 0.5 else w[:at]), ", ".join(w[at:]).upper(), word()]
        docs.append((r.choice([k, k, k, None, 5]), " ".join(parts)))
    # 16 shingles, of which exactly 12 are there, and 11.
    items.append((40, " ".join(f"q{k}" for k in range(20))))
    docs += [(100, " ".join(f"q{k}" for k in range(16))), (101, " ".join(f"q{k}" for k in range(15))), (102, "we said: PARIS is the capital!"), (103, None)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute_contained(docs, items)
    assert {(100, 40, 16, 12), (102, 31, 1, 1)} <= want and not [x for x in want if x[:2] == (101, 40)]
    assert {tuple(x) for x in decontaminate.find(d, b).collect()} == want
    clean = [t for _, t in docs if not brute_contained([(0, t)], items)]
    assert Counter(x.text for x in decontaminate.remove_contaminated(d, b).collect()) == Counter(clean)


def test_embeddings_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, vectors = [], []
    for k in range(12):
        centre = rng.normal(size=16)
        vectors += [(k % 3, (centre + rng.normal(size=16) * s).tolist()) for s in rng.choice([0.05, 0.15, 0.3], 15)]
    vectors += [(0, vectors[0][1])] * 4 + [(None, vectors[0][1]), (0, None), (0, [0.0] * 16), (0, [float("nan")] * 16), (0, [float("inf")] + [1.0] * 15), (0, []), (0, [1.0, 2.0]), (0, [2.0, 4.0]), (1, [1.0, None])]
    rows = [(i, v, label, i) for i, (label, v) in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, n int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    ok = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    link = lambda a, b: a[0] is not None and a[0] == b[0] and ok(a[1]) and ok(b[1]) and len(a[1]) == len(b[1]) and np.dot(a[1], b[1]) / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.93
    root = list(range(len(vectors)))
    links = [[j for j in range(len(vectors)) if j != i and link(vectors[i], vectors[j])] for i in range(len(vectors))]
    for _ in root:
        for i, js in enumerate(links):
            for j in js:
                root[i] = root[j] = min(root[i], root[j])
    assert got == {i: (len(js), root[i]) for i, js in enumerate(links)}
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    assert [(r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df.limit(1).withColumn("vec_id", F.lit(None).cast("long"))).collect()] == [(None, True)]


def test_tiny_and_huge_vectors(spark):
    base = [1.0, 2.0, -3.0]
    rows = [(i, [x * f for x in base], 1) for i, f in enumerate([1.0, 5e-324, 1e-310, 1e-200, 1e300, 1e-3])] + [(9, [5e-324, 0.0, 0.0], 1)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert got == {**{i: (5, 0) for i in range(6)}, 9: (0, 9)}


def test_planted_partners_across_many_lists(spark, tmp_path):
    """40 lists or so at the production block and list sizes: every planted partner is found, by brute force nothing else."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=(20_000, 16))
    near = base[:400] + rng.normal(size=(400, 16)) * np.linalg.norm(base[:400], axis=1, keepdims=True) * 0.09
    vectors = np.concatenate([base, near]).astype(np.float32)
    pd.DataFrame({"vec_id": range(len(vectors)), "embedding": list(vectors), "label": 3}).to_parquet(tmp_path / "v.parquet")
    df = spark.read.parquet(str(tmp_path / "v.parquet"))
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df).collect()}
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    want = np.concatenate([(unit[i : i + 500] @ unit.T >= embedding_dedup.THRESHOLD).sum(1) - 1 for i in range(0, len(unit), 500)])
    assert want[20_000:].sum() >= 300 and got == dict(enumerate(want.tolist()))


@pytest.mark.parametrize("rank", [4, 8])
def test_embeddings_of_low_rank_lose_no_link_between_lists(spark, monkeypatch, rank):
    monkeypatch.setattr(embedding_dedup, "PER_LIST", 60)
    monkeypatch.setattr(embedding_dedup, "BLOCK_BYTES", 300 * 8 * 32)
    rng = np.random.default_rng(rank)
    vectors = rng.normal(size=(3000, rank)) @ rng.normal(size=(rank, 32))
    labels = (np.arange(len(vectors)) % 10 == 0).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, labels, strict=True))], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()}
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    link = (unit @ unit.T >= embedding_dedup.THRESHOLD) & (labels[:, None] == labels)
    np.fill_diagonal(link, False)
    root = np.arange(len(link))
    while (low := np.minimum(root, np.where(link, root, len(link)).min(1))).tolist() != root.tolist():
        root = low
    assert link.sum() > 1000
    assert got == {i: (int(link[i].sum()), int(root[i])) for i in range(len(link))}


def test_shards_are_even_and_mostly_stay(spark):
    names = [f"s{k}" for k in range(10)]
    before, after = sharding.lookup_table(names, 1009), sharding.lookup_table(names[:-1], 1009)
    assert max(Counter(before).values()) - min(Counter(before).values()) <= 1
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 9)
    assert moved < 0.1 * 1009
    for bad in (1008, 7):
        with pytest.raises(ValueError, match="not a prime"):
            sharding.lookup_table(names, bad)
    # The filling again, from each shard's whole order of preference.
    number = lambda salt, n: int(hashlib.md5(f"{salt}:{n}".encode()).hexdigest()[:15], 16)
    prefer = [[(number("offset", n) + j * (number("skip", n) % 1008 + 1)) % 1009 for j in range(1009)] for n in names]
    owner: dict = {}
    while len(owner) < 1009:
        for k, order in enumerate(prefer):
            free = [s for s in order if s not in owner]
            if free:
                owner[free[0]] = k
    assert before == [owner[s] for s in range(1009)]
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, shard string")
    rows = sharding.place(df, F.col("doc_id"), names).collect()
    assert len(rows) == 3 and len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert sharding.place(df.limit(0), F.col("doc_id"), names).count() == 0


def brute_line_dedup(docs):
    pages, count = defaultdict(set), Counter()
    for d in docs:
        pages[d.source].add(d.text)
    for source, texts in pages.items():
        for text in texts:
            count.update((source, line) for line in {x.strip(" \t\r") for x in text.split("\n")} - {""})
    bad = {k for k, n in count.items() if n >= line_dedup.MIN_PAGES and n > line_dedup.RATIO * len(pages[k[0]])}
    return {d.doc_id: "\n".join(x for x in d.text.split("\n") if (d.source, x.strip(" \t\r")) not in bad) for d in docs}


def test_pipeline_stages_against_brute_force(spark):
    docs = common.table(spark, SF, "documents")
    benchmark = [(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    kept, dropped = docs, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = kept.collect()
        texts = {r.doc_id: r.text for r in before}
        assert len(texts) == len(before)
        out = common.checkpointed(stage(spark, kept, SF))
        rows, dropped[name] = out.collect(), len(before)
        if k == 4:
            by_doc = defaultdict(list)
            for r in rows:
                by_doc[r.doc_id].append(r)
            assert set(by_doc) == set(texts)
            for i, text in texts.items():
                ids, at = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID], 0
                for n, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
                    assert (r.piece, r.start) == (n, at) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
                    at += r.length
                assert at == len(ids)
            places = defaultdict(list)
            for r in rows:
                places[r.sequence_id].append((r.offset, r.length))
            for spans in places.values():
                assert [o for o, _ in sorted(spans)] == [sum(n for _, n in sorted(spans)[:j]) for j in range(len(spans))] and sum(n for _, n in spans) <= 1024
            assert len(places) <= -(-sum(r.length for r in rows) // 1024) + 1
            break
        assert out.columns == docs.columns
        left = {r.doc_id: r.text for r in rows}
        assert len(left) == len(rows)
        if k == 0:
            want = {i: t for i, t in texts.items() if t and any(c.isalpha() for c in t)}
        elif k == 1:
            want = brute_line_dedup(before)
            assert all(r.n_chars == len(r.text) for r in rows)
        elif k == 2:
            want = {i: texts[i] for i, (_, c) in brute_components(texts.items()).items() if i == c}
        else:
            bad = {d for d, *_ in brute_contained(texts.items(), benchmark)}
            want = {i: t for i, t in texts.items() if i not in bad}
        assert left == want, name
        dropped[name] -= len(left)
        kept = out
    assert dropped["near_dedup"] and dropped["decontamination"]


KIND = "doc_id long, text string, lang string, source string, n_chars long"
TEXT = "same text of the thing is here"
ODD = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (None, "the thing and of the", None, None, 5), (None, "the thing and of the", None, "t", 5), (3, "a " * 50_000, "en", "s", 1), (4, TEXT, "en", None, 1), (4, TEXT, "en", None, 1),
    (5, "der die und das ist ein", "de", "s", None), (4, "another text with the id of that one", "en", "s", 0), (6, "another text with the id of that ONE", None, "s", 0), (None, TEXT.upper(), None, None, 0), (7, "1 2 3 !", "en", "s", 1), (8, "paris is the capital they say", "en", "s", 1),
]


def test_pipeline_on_odd_documents(spark, tmp_path):
    for name, data, items in (("odd", ODD, [(1, None), (2, "Paris is the capital"), (None, "")]), ("none", [], [])):
        os.makedirs(tmp_path / name)
        spark.createDataFrame(data, KIND).write.parquet(str(tmp_path / name / "documents.parquet"))
        spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / name / "benchmark.parquet"))
    packed = corpus_pipeline.run(spark, str(tmp_path / "odd")).collect()
    # Of 4's texts the further one links with 6, which has an id of its own and so stays.
    assert sorted((r.doc_id or 0, r.piece) for r in packed if r.doc_id != 3) == [(0, 0), (4, 0), (5, 0), (6, 0)]
    assert sum(r.length for r in packed if r.doc_id == 3) == len(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode("a " * 50_000).ids) + 1
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_pipeline_stages_with_clashing_columns(spark, tmp_path):
    spark.createDataFrame([(2, "Paris is the capital")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    names = ["language", "lines", "row_key", "id_of", "first_of", "is_repeated", "text_key", "host", "w", "s", "h", "doc", "item", "n", "rep"]
    docs = spark.createDataFrame(ODD, KIND).select("*", *[F.monotonically_increasing_id().alias(c) for c in names])
    docs = common.checkpointed(docs)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = common.checkpointed(stage(spark, docs, str(tmp_path)))
        assert out.columns == docs.columns
        whole = {r.n: r for r in docs.collect()}
        for r in out.collect():
            assert [r[c] for c in names] == [whole[r.n][c] for c in names] and r.doc_id == whole[r.n].doc_id
        docs = out
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 3, 4, 5, 6]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).where("piece = 0").count() == 5


def test_sketches_do_not_depend_on_how_texts_are_sliced(monkeypatch):
    texts = ["", None, "one", "a b c d e f g", "w" * 300 + " x y z v u", "long text " * 400]
    frame = pd.DataFrame({"id": range(len(texts)), "th": range(len(texts)), "text": texts})
    whole = next(near_dedup._sketches(iter([frame])))
    monkeypatch.setattr(near_dedup, "CHARS", 10)
    parts = pd.concat(list(near_dedup._sketches(iter([frame]))), ignore_index=True)
    assert whole["regs"].tolist() == parts["regs"].tolist() and whole["n"].tolist() == parts["n"].tolist()
    hashes = near_dedup.WordHashes()
    near_dedup.shingle_hashes(near_dedup.tokens(texts[4]), hashes)
    assert sorted(hashes) == [b"u", b"v", b"x", b"y", b"z"]
