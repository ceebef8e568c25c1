"""The training-data operators against brute force on small tables with every odd case: NULLs, empty and very long
texts, ties, repeated rows, empty tables, and columns whose names clash with those of the operators."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relfeat.llm.byte_bpe import TreeEncoder, encode_and_decode
from relfeat.llm.common import without
from relfeat.llm.decontaminate import decontaminate
from relfeat.llm.exact_dedup import exact_dedup
from relfeat.llm.html_text import align, blocks, fold, main_text, own_text, parsed, written, Wrapper
from relfeat.llm.near_dedup import near_dedup, star_components
from relfeat.llm.sharding import kd_shards
from relfeat.llm.token_ids import WordEncoder, token_id_round_trip
from relfeat.llm.toxicity import toxicity
from relfeat.llm.url_filter import reputation, url_filter
from relfeat.llm.warc import read_warc, warc_round_trip, write_warc

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru") for b in ("te", "no", "sa") for c in ("", "n", "é", "x")]

# columns that operators use inside, to clash with
DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in ("text_key", "digest", "run", "n", "id", "node", "shard", "score", "items", "a key")]
)
PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())] + [T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "payload", "n")])


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(11)
    base = prose(rng, 120)
    edited = base.split()
    edited[5] = "other"
    far = base.split()
    for i in range(0, 120, 9):
        far[i] = f"far{i}"
    rows = [
        (1, base), (2, base.upper().replace("É", "é")), (3, " ".join(edited)), (4, " ".join(far)), (5, ""), (6, None), (7, " \t\n"),
        (8, "one"), (9, "One"), (10, "one two"), (11, "x" * 30_000), (12, prose(rng, 6000)), (13, base), (13, base), (14, "É é"),
        (15, "é é"), (None, base), (None, "alone without an id"), (16, base + " tail"), (17, "a\x00b 漢字 🙂 don't"),
    ]
    return rows + [(100 + i, prose(rng, rng.randint(1, 60))) for i in range(30)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, None if i == 3 else "en", f"s{(i or 0) % 3}", *["x"] * 10) for i, t in odd_texts()], DOCS).repartition(4)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def by_row(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


def key(t):
    return (t[0] is None, *map(str, t))


def test_sorted_runs_are_exchanged_once_and_merged_in_order(spark):
    from relfeat.llm.exact_dedup import FINGERPRINT, merged

    lines = [(r, bytes([d]), 1, 5, None if r == 3 else 10 * r + d, 2) for r in range(20) for d in range(r % 5 + 1)]
    runs = spark.createDataFrame(lines, "run INT, digest BINARY, n_bytes LONG, second LONG, keep_id LONG, group_size LONG").repartitionByRange("digest")
    for _ in range(2):
        runs = merged(runs.withColumn("run", F.expr("CAST(run DIV 8 AS INT)")), F.desc_nulls_last("keep_id"))
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan and plan.count("Window") >= 2
    want = {}
    for r, d, _, _, i, n in lines:
        best, rows = want.get(d, (None, 0))
        want[d] = (max((x for x in (best, i) if x is not None), default=None), rows + n)
    assert {bytes(r.digest): (r.keep_id, r.group_size) for r in runs.collect()} == want and len(FINGERPRINT) == 3


def test_exact_dedup(spark, docs):
    rows = odd_texts()
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(AZ), []).append(i)
    for keep, best in (("largest", max), ("smallest", min)):
        expected = []
        for i, t in rows:
            n = (t or "").translate(AZ)
            ids = [x for x in groups[n] if x is not None]
            k = best(ids) if ids else None
            expected.append((i, k, len(groups[n]), i == k, hashlib.sha256(n.encode()).hexdigest()))
        for fan_in in (2, 8):
            got = [tuple(r) for r in exact_dedup(docs, keep=keep, fan_in=fan_in).drop("text_key").collect()]
            assert sorted(got, key=key) == sorted(expected, key=key)
    assert exact_dedup(empty_docs(spark)).count() == 0


def test_without_keeps_columns_and_other_rows(docs):
    found = exact_dedup(docs, keep="largest")
    left = without(docs, found.where("NOT kept"))
    assert left.columns == docs.columns
    ids = [r.doc_id for r in left.collect()]
    assert [ids.count(i) for i in (1, 2, 13, 5, 6, 7)] == [0, 0, 2, 0, 1, 1]
    assert ids.count(None) == 1  # the NULL id whose text another id has goes, the other stays


def shingles(text: str | None, n: int) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(AZ))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components_by_force(rows, n, num, den):
    sets: dict[int, set] = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, set()).add(shingles(t, n))
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and any(a and b and den * len(a & b) >= num * len(a | b) for a in sets[i] for b in sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("n,num,den", [(3, 85, 100), (5, 4, 5)])
def test_near_dedup(docs, n, num, den):
    rows = odd_texts()
    expected = components_by_force(rows, n, num, den)
    got = near_dedup(docs, words_each=n, similar=(num, den)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == (expected[r.doc_id], r.doc_id == expected[r.doc_id])
    assert sorted(r.n_shingles for r in got) == sorted(len(shingles(t, n)) for _, t in rows)


def test_near_dedup_of_a_group_with_many_outsiders(spark):
    """Copies of one text with few to many edits: most near ones connect, those further off must not."""
    rng = random.Random(3)
    base = prose(rng, 150).split()
    rows = []
    for i in range(120):
        words = list(base)
        for k in rng.sample(range(150), i % 9):
            words[k] = f"w{i}_{k}" if i % 2 else WORDS[(i + k) % len(WORDS)]
        rows.append((i, " ".join(words)))
    expected = components_by_force(rows, 3, 85, 100)
    got = near_dedup(spark.createDataFrame(rows, "doc_id LONG, text STRING"), words_each=3, similar=(85, 100))
    assert {r.doc_id: r.component_id for r in got.collect()} == expected
    assert 1 < len(set(expected.values())) < 120


def test_pages_of_one_template_are_hardly_compared(spark, monkeypatch):
    """Each two pages are about 0.7 alike, with edits from a shared pool: all share buckets, none is linked."""
    from relfeat.llm import near_dedup as module

    rng = random.Random(12)
    base, pool = [f"t{i}" for i in range(200)], [f"e{i}" for i in range(400)]
    rows = []
    for i in range(300):
        words = list(base)
        for k in rng.sample(range(0, 200, 3), 13):
            words[k] = rng.choice(pool)
        rows.append((i, " ".join(words)))
    seen = {}
    real = module.stored

    def counted(df, name):
        table = real(df, name)
        if name == "pairs":
            seen[name] = table.count()
        return table

    monkeypatch.setattr(module, "stored", counted)
    expected = components_by_force(rows, 3, 85, 100)
    got = near_dedup(spark.createDataFrame(rows, "doc_id LONG, text STRING"), words_each=3, similar=(85, 100))
    assert {r.doc_id: r.component_id for r in got.collect()} == expected
    assert len(set(expected.values())) == 300 and seen["pairs"] < 300 * 299 / 2 / 10


def test_python_tasks_give_memory_back():
    """After the last slice the worker keeps neither the tables of powers nor freed memory."""
    import pyarrow as pa

    from relfeat.llm import common

    def resident() -> int:
        return int(re.search(r"RssAnon:\s+(\d+)", open("/proc/self/status").read())[1])

    def held() -> int:
        batches = (pa.RecordBatch.from_pydict({"text": ["one two three " * 10_000] * 20}) for _ in range(2))
        top = 0
        for batch in common.slices(batches, "text"):
            words = common.Words(batch.column("text"), ~common.byte_class((32, 32)))
            top = max(top, len(common.powers(len(words.data))[0]), len(common._powers["up"]))
        return top

    common.give_back()
    before = resident()
    assert held() > 1 << 20
    assert len(common._powers["up"]) == len(common._powers["down"]) == 1
    assert resident() - before < 24 << 10


def test_likely_keeps_all_that_are_wanted(spark):
    from relfeat.llm.common import likely, stored

    ids = stored(spark.range(0, 30_000, 10), "ids")
    rows = spark.range(-100, 30_000).selectExpr("nullif(id, -1) AS n")
    got = [r.n for r in likely(rows, "n", ids).collect()]
    assert set(range(0, 30_000, 10)) <= set(got) and len(got) == len(set(got)) < 3_300
    assert likely(rows, "n", ids.limit(0)).count() == 0


def test_near_dedup_moves_no_text(spark, docs, monkeypatch):
    """Texts stay where they are read and sets move only for pairs, however large the tables."""
    from relfeat.llm import near_dedup as module

    plans = {}
    real = module.stored

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(module, "stored", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near_dedup(docs, words_each=3, similar=(85, 100)).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning" not in plans["sets"] and "SortMergeJoin" not in plans["sets"]
    assert "LeftSemi" in plans["links"]


def test_near_dedup_empty(spark):
    assert near_dedup(empty_docs(spark)).count() == 0


def test_star_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 50), (90, 50), (100, 90)]
    got = dict(map(tuple, star_components(spark.createDataFrame(edges, "u LONG, v LONG")).collect()))
    assert got == {i: 0 for i in range(1, 41)} | {100: 50, 90: 50}


def item_windows(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(AZ))
    return [tuple(w)] if 0 < len(w) < 13 else [tuple(w[i : i + 13]) for i in range(len(w) - 12)]


@pytest.mark.parametrize("block_bytes", [12_000, 8 << 20])
def test_decontaminate(spark, docs, block_bytes):
    rng = random.Random(2)
    base = odd_texts()[0][1]
    items = [
        (1, " ".join(base.split()[10:40])), (2, "one two"), (3, None), (None, base), (4, ""), (10, prose(rng, 30)), (2, "far0"),
        (9, "Alone, without"), (11, "x" * 30_000), (12, "the the the the the the the the the the the the the the"), (13, "the " * 13),
    ]
    rows = odd_texts() + [(200, "the " * 40), (201, "pre " + items[5][1] + " post" * 400), (202, "alone; WITHOUT an")]
    table = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    got = decontaminate(table, spark.createDataFrame(items, "item_id LONG, text STRING"), block_bytes=block_bytes)
    windows = [(str(i), v) for i, t in items if i is not None and t is not None for v in item_windows(t)]
    expected = []
    for i, t in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(AZ))
        hit, names = set(), set()
        for name, v in windows:
            for k in range(len(w) - len(v) + 1):
                if tuple(w[k : k + len(v)]) == v:
                    hit.update(range(k, k + len(v)))
                    names.add(name)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        expected.append((i, len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    assert sorted((tuple(r) for r in got.drop("text_key").collect()), key=key) == sorted(expected, key=key)
    assert any(e[-1] for e in expected) and any(e[2] and not e[-1] for e in expected)


def test_decontaminate_without_items_or_documents(spark, docs):
    none = spark.createDataFrame([], "item_id LONG, text STRING")
    assert {(r.n_hit, r.contaminated) for r in decontaminate(docs, none).collect()} == {(0, False)}
    assert decontaminate(empty_docs(spark), spark.createDataFrame([(1, "a b")], "item_id LONG, text STRING")).count() == 0


def test_token_ids(spark, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    ids = {t: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for _, t in odd_texts()}
    got = token_id_round_trip(docs, path).collect()
    crc = lambda x: zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == sorted(((i, len(ids[t]), crc(ids[t])) for i, t in odd_texts()), key=key)
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    assert token_id_round_trip(empty_docs(spark), path).count() == 0


PIECES = ["a", "Bc", "'s", "'", "'Re", " ", "  ", "\n", "\u00a0", "\u0301", "e\u0301", "ÄÖ", "1", "²", "漢字", "🙂", "<|endoftext|>", ".", "!!", "J\u030c", "I\u0307", "=\u0338", "Σ", "\x00", "\x1c", "don't"]


def test_encoders_on_random_texts():
    import pyarrow as pa
    from tokenizers import Tokenizer

    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 50))) for _ in range(1500)] + ["a" * 5000, " " * 3000, "1" * 999]
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    ids, sizes = WordEncoder(path, 2).encode(pa.array(texts))
    at = 0
    for size, plain in zip(sizes, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert ids[at : at + size].tolist() == plain.ids + [2]
        at += size
    tree = TreeEncoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for text in texts:
        plain = tree.bpe.encode_ordinary(text)
        assert tree.encode(text, 4) == tree.encode(text, 33) == plain
        assert tree.decode(plain, 3) == text.encode()


def test_byte_bpe(spark, docs):
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tree = TreeEncoder(ranks, public_tokenizers.PATTERN)
    got = encode_and_decode(docs, ranks, public_tokenizers.PATTERN, leaf=64).collect()
    expected = [(i, tree.bpe.encode_ordinary(t or ""), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in odd_texts()]
    assert sorted(((r.doc_id, r.ids, r.decoded_sha256) for r in got), key=key) == sorted(expected, key=key)
    assert all(r.ids_sha256 == hashlib.sha256(",".join(map(str, r.ids)).encode()).hexdigest() for r in got)
    assert encode_and_decode(empty_docs(spark), ranks, public_tokenizers.PATTERN).count() == 0


def odd_pages():
    article = "<article><h1>Head &amp; more</h1>" + "<p>Text of the page.</p>" * 60 + "</article>"
    return [
        (1, "http://WWW.Example.com/en/x?q#f", article), (2, "https://a.net/fr/", article), (3, None, article), (4, "no scheme", None),
        (5, "http://b.net", ""), (6, "http://com/", "short"), (7, "http://x.example.com/en/\r\nEvil: 1", "short"), (7, "http://x.example.com/en/1", "short"),
        (None, "http://xcom/a", article), (8, "http://h.org:80/p://q/en", "y" * 200_000), (9, "x://http://www.example.com/en/", "é" * 600),
        (10, "http://net/fr/#://", "é" * 600),
    ]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in odd_pages()], PAGES).repartition(3)


def test_warc(spark, pages):
    holders: dict[bytes, int] = {}
    for i, _, h in odd_pages():
        if i is not None and len((h or "").encode()) >= 1000:
            holders[(h or "").encode()] = max(i, holders.get((h or "").encode(), i))
    expected = []
    for i, _, h in odd_pages():
        b = (h or "").encode()
        to = holders.get(b) if i is None or i < holders.get(b, i) else None
        expected.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if to else "response", to))
    assert sorted(map(tuple, warc_round_trip(pages).collect()), key=key) == sorted(expected, key=key)
    assert warc_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_warc_long_payloads_are_chunk_rows(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "".join(chr(97 + (i * k) % 26) for k in range(1, 50_000 + i))) for i in range(1, 6)]
    rows += [(9, "http://h/9", rows[0][2]), (9, "again", rows[0][2]), (None, "none", rows[0][2]), (10, None, "e\u0301" * 9_000), (11, "s", "short"), (12, "n", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    archives = write_warc(pages, str(tmp_path / "warc"), chunk=1_000, long_bytes=10_000)
    read = read_warc(spark, archives, chunk=700).toPandas()
    texts = {(i, "" if u is None else u): (h or "").encode() for i, u, h in rows}
    seen = 0
    for (record, url), part in read.assign(page_id=read["page_id"].fillna(-1)).groupby(["page_id", "url"]):
        part, payload = part.sort_values("chunk"), texts[None if record < 0 else int(record), url]
        end = part.iloc[-1]
        assert end["last"] and end["payload_bytes"] == len(payload) and end["payload_digest"] == hashlib.sha1(payload).hexdigest()
        revisit = payload == rows[0][2].encode() and record != 9
        assert end["record_type"] == ("revisit" if revisit else "response") and (end["refers_to"] == 9) == revisit
        if not revisit:
            assert b"".join(part["data"]) == payload
        seen += 1
    assert seen == len(rows)


def test_warc_chunks(spark, pages, tmp_path):
    archives = write_warc(pages, str(tmp_path / "warc"))
    chunks = read_warc(spark, archives, chunk=1000).where("page_id = 8").orderBy("chunk").collect()
    assert len(chunks) == 200 and b"".join(r.data for r in chunks) == b"y" * 200_000
    assert [r.payload_digest for r in chunks[:3]] == [hashlib.sha1(b"y" * 1000 * k).hexdigest() for k in (1, 2, 3)]
    assert [r.last for r in chunks].count(True) == 1


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def test_url_filter(spark, pages):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (99, 1), (8, None)], "page_id LONG, bad INT")
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in url_filter(pages, labels, RULES).collect()}
    assert got == {
        (1, "www.example.com", "/en/x"): ("www.example.com/en/", "allow"), (2, "a.net", "/fr/"): ("net/fr/", "block"), (3, "", ""): (None, "allow"),
        (4, "", ""): (None, "allow"), (5, "b.net", ""): (None, "allow"), (6, "com", "/"): ("com/", "allow"),
        (7, "x.example.com", "/en/\r\nEvil: 1"): ("example.com/en/", "block"), (7, "x.example.com", "/en/1"): ("example.com/en/", "block"),
        (None, "xcom", "/a"): (None, "allow"), (8, "h.org:80", "/p://q/en"): (None, "allow"), (9, "http:", "//www.example.com/en/"): (None, "allow"),
        (10, "net", "/fr/"): ("net/fr/", "block"),
    }
    assert url_filter(spark.createDataFrame([], PAGES), labels, RULES).count() == 0


def test_reputation_shrinks_towards_domain(spark):
    rows = [("a.bad.org", 1)] * 40 + [("b.bad.org", 1)] * 38 + [("b.bad.org", 0)] * 2 + [("c.bad.org", 1)] + [("x.good.org", 0)] * 60 + [("y.good.org", 0)]
    rate = {r.host: r["mean"] for r in reputation(spark.createDataFrame(rows, "host STRING, bad LONG")).collect()}
    assert rate["a.bad.org"] > rate["c.bad.org"] > 0.5 > rate["y.good.org"] > rate["x.good.org"] > 0


def test_hosts_without_labels_lean_on_domain_suffix_and_all(spark):
    urls = [f"http://{h}.bad.org/{i}" for h in "abcdef" for i in range(30)] + [f"http://{h}.good.org/{i}" for h in "abcdef" for i in range(30)]
    urls += [f"http://{h}.fine{h}.net/{i}" for h in "abcdef" for i in range(30)]
    new = ["http://new.bad.org/", "http://new.good.org/", "http://x.other.net/", "http://nowhere.xyz/", None]
    pages = spark.createDataFrame(list(enumerate(urls + new)), "page_id LONG, url STRING")
    labels = spark.createDataFrame([(i, int(".bad." in u and i % 10 > 0)) for i, u in enumerate(urls)], "page_id LONG, bad INT")
    got = {r.page_id: r for r in url_filter(pages, labels, []).collect()}
    bad, good, other, nowhere, none = (got[len(urls) + i] for i in range(5))
    assert bad.verdict == "block" and bad.bad_rate > 0.8 and bad.bad_at_least > 0.3
    assert {good.verdict, other.verdict, nowhere.verdict, none.verdict} == {"allow"}
    assert good.bad_rate < 0.1 and other.bad_rate < 0.1 and nowhere.bad_rate == none.bad_rate == pytest.approx(162 / 540)
    assert bad.bad_at_least < got[1].bad_at_least
    assert {(r.verdict, r.bad_rate) for r in url_filter(pages, labels.limit(0), []).collect()} == {("allow", None)}


def test_kd_shards(spark, docs):
    got = kd_shards(docs, shards=8).collect()
    sizes = {i: len((t or "").encode()) + 1 for i, t in odd_texts() if i is not None}
    assert all(r["size"] == sizes[r.doc_id] for r in got if r.doc_id is not None) and len(got) == len(odd_texts())
    for shard in range(8):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert kd_shards(empty_docs(spark)).count() == 0


def test_kd_shards_are_even_with_one_source_and_many_copies(spark):
    rng = random.Random(1)
    rows = [(i, "copy " * 40 if i % 3 == 0 else prose(rng, rng.randint(1, 80)), "en", "s0" if i % 2 else f"s{i % 7}") for i in range(6000)]
    for shards in (8, 5, 1):
        got = kd_shards(spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING"), shards=shards)
        totals = [r.b for r in got.groupBy("shard").agg({"size": "sum"}).toDF("shard", "b").collect()]
        assert len(totals) == shards and max(totals) - min(totals) <= 0.01 * sum(totals) + 1000


def test_equal_texts_share_a_shard(spark):
    """Copies with metadata of their own: only groups that a cut falls into are parted, fewer than there are shards."""
    rng = random.Random(3)
    texts = [None, ""] + [prose(rng, rng.randint(1, 60)) for _ in range(400)]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None]), f"s{rng.randrange(9)}") for i in range(4000)]
    got = kd_shards(spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING"), shards=8).collect()
    by_id = {r.doc_id: r for r in got}
    shards: dict[str, set] = {}
    for i, t, *_ in rows:
        raw = (t or "").encode()
        assert (by_id[i].size, by_id[i].text_crc32, by_id[i].law) == (len(raw) + 1, zlib.crc32(raw), "bytes")
        shards.setdefault(t or "", set()).add(by_id[i].shard)
    assert len(got) == 4000 and sum(len(s) > 1 for s in shards.values()) < 8
    totals = [sum(r.size for r in got if r.shard == k) for k in range(8)]
    assert max(totals) - min(totals) <= 0.01 * sum(totals) + 1000


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li>a<li>b</ul></nav>
<div class="cookie-notice">We use cookies</div><div id=sidebar>side</div><main><article class=post><h2>T&amp;i <i>tl</i>e</h2>
<p>One<p>Two&nbsp;x<br>y<script>var t="</p>";</script><div class="ad">buy</div><ul><li>q<li>r</ul><form>mail<input></form>
<!-- no --><section id="comments"><article>nice</article></section><aside>z</aside><pre>a  b</pre></article></main><footer>f</footer>"""


def test_blocks_of_a_page():
    assert own_text(*blocks(PAGE)) == "T&i tle One Two x y q r a b"
    assert own_text(*blocks("<p>no article</p><nav>menu</nav> tail")) == "no article tail"
    assert own_text(*blocks("<main>in <b>ma</b>in</main> out")) == "in main"
    assert own_text(*blocks("")) == "" and own_text(*blocks("<article><p class='x")) == ""


def test_wrappers_accept_what_they_come_from():
    rng = random.Random(4)
    for _ in range(60):
        streams = [[rng.choice(["p", "/p", "#article", "li", "/li", "h1"]) for _ in range(rng.randint(0, 14))] for _ in range(5)]
        wrapper = fold(streams[0])
        for s in streams[1:]:
            wrapper = align(wrapper, fold(s))
        assert parsed(written(wrapper)) == wrapper
        matcher = Wrapper(written(wrapper))
        for s in streams:
            texts = [f"t{i}" for i in range(len(s))]
            assert matcher.text(s, texts) == own_text(s, texts)


def test_main_text(spark, pages):
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in main_text(pages).collect()}
    article = "Head & more" + " Text of the page." * 60
    for i, url, h in odd_pages():
        expected = article if h and "article" in h else h or ""
        assert got[i, url] == (expected, len(expected))
    assert main_text(spark.createDataFrame([], PAGES)).count() == 0


def test_main_text_leaves_out_what_stays_the_same_on_a_host(spark):
    page = "<body><article><div class='zz'>Our terms of use</div><h1>Title {0}</h1><p>Story {0}.</p><div class=ad>buy</div><p>Read on</p></article>"
    rows = [(i, f"http://a.com/{i}", page.format(i)) for i in range(6)]
    rows += [(10, "http://one.com/", page.format(10)), (11, "http://one.com/copy", page.format(10))]
    rows += [(20 + i, f"http://b.com/{i}", f"<body><div class='social'><p>Follow us</p><p>Post {i}</p></div></body>") for i in range(4)]
    rows += [(30 + i, f"http://c.com/{i}", f"<nav>{i}</nav><article><p>Same text</p></article>") for i in range(4)]
    rows += [(40 + i, f"http://d.com/{i}", f"<article><p>{'Shared' if i < 3 else 'Other'}</p><p>Own {i}</p></article>") for i in range(6)]
    got = {r.page_id: r for r in main_text(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()}
    assert [got[i].text for i in range(6)] == [f"Title {i} Story {i}." for i in range(6)]
    assert got[10].text == got[11].text == "Our terms of use Title 10 Story 10. Read on"
    assert [got[20 + i].text for i in range(4)] == [f"Post {i}" for i in range(4)]
    assert [got[30 + i].text for i in range(4)] == ["Same text"] * 4
    assert got[40].text == "Shared Own 0" and all(r.fits and r.n_chars == len(r.text) for r in got.values())


def test_main_text_keeps_editions_of_a_story(spark):
    story = "".join(f"<p>Paragraph {k} of the whole story.</p>" for k in range(6))
    rows = [(i, f"http://a.com/{i}", f"<article><p>Updated {i}:00</p>{story}</article>") for i in range(2)]
    rows += [(10 + i, f"http://b.com/{i}", f"<article><div class=zz>Terms</div>{story}<p>Edition {i}</p></article>") for i in range(5)]
    rows += [(20 + i, f"http://c.com/{i}", f"<article><div class=zz>Terms</div><p>{'Words of its own %d. ' % i * 9}</p></article>") for i in range(5)]
    rows += [(30, "http://d.com/", "<article><section class='related-work'>Earlier papers</section><div class='related-posts'>x</div><p>Text</p></article>")]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()}
    told = " ".join(f"Paragraph {k} of the whole story." for k in range(6))
    assert [got[i] for i in range(2)] == [f"Updated {i}:00 {told}" for i in range(2)]
    assert [got[10 + i] for i in range(5)] == [f"Terms {told} Edition {i}" for i in range(5)]
    assert [got[20 + i] for i in range(5)] == [("Words of its own %d. " % i * 9).strip() for i in range(5)]
    assert got[30] == "Earlier papers Text"


def test_wrappers_match_in_linear_time():
    wrapper = Wrapper("( ( p )+ )+ " + "( p )? " * 40 + "p " * 40 + "h1")
    assert wrapper.accepts(["p"] * 5000 + ["h1"]) and not wrapper.accepts(["p"] * 5000)


def test_hosts_past_the_symbol_bound_have_several_wrappers(spark, monkeypatch):
    """No page is left without a wrapper, not even one that is larger than the bound by itself."""
    from relfeat.llm import html_text as module

    rng = random.Random(6)
    streams = [[rng.choice(["p", "/p", "#article", "li", "/li", "h1"]) for _ in range(rng.randint(5, 60))] for _ in range(150)]
    monkeypatch.setattr(module, "MAX_SYMBOLS", 30)
    names = [module.folded(s) for s in streams]
    group = module.pd.DataFrame({"host": "h", "name": [n for _, n in names], "wrapper": [w for w, _ in names], "whole": True})
    got = module.inferred(group.drop_duplicates("name"))
    wrappers = got.dropna(subset="wrapper").set_index("into")["wrapper"]
    into = got.set_index("name")["into"]
    assert 1 < len(wrappers) < len(got) and all(Wrapper(wrappers[into[n]]).accepts(s) for s, (_, n) in zip(streams, names))
    monkeypatch.undo()
    # a host with more streams than a portion, beyond the bound in each: all pages fit, in a few rounds
    tags = ["section", "ul", "ol", "table", "pre", "h1", "h2", "h3", "h4", "div", "p", "blockquote"]
    rows = [(0, "http://big.com/0", "<article>" + "".join(f"<{t}>{k}</{t}>" for k, t in enumerate(rng.choices(tags, k=5000))) + "</article>")]
    rows += [(i, f"http://big.com/{i}", "<article>" + "".join(f"<{t}>{i} {k}</{t}>" for k, t in enumerate(rng.choices(tags, k=3))) + "</article>") for i in range(1, 90)]
    got = main_text(spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")).collect()
    assert len(got) == 90 and all(r.fits for r in got)


def test_main_text_has_names_of_its_own(spark):
    rows = [(1, "http://a.com/", "<article>One</article>", "t", "w", "h", 5, "s")]
    odd = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, template STRING, wrapper STRING, host STRING, page INT, symbols STRING")
    assert [(r.page_id, r.text) for r in main_text(odd).collect()] == [(1, "One")]


def test_toxicity_finds_gapped_words_and_new_endings(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(1200):
        words = [rng.choice(WORDS) + rng.choice(WORDS)[:3] for _ in range(rng.randint(5, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "grobnak" if rng.random() < 0.5 else "pluzzi" + rng.choice(WORDS)[:3])
        rows.append((i, ". ".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9))))
        labels.append((i, int(toxic)))
    clean = prose(rng, 30)
    rows += [(5000, f"{clean} g r o b n a k"), (5001, f"{clean} gro-bn.ak"), (5002, f"{clean} grobxnak"), (5003, f"{clean} pluzziwum"), (5004, clean), (5005, None), (5006, ""), (None, clean)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    got = {r.doc_id: r for r in toxicity(docs, spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id LONG, toxic INT")).collect()}
    held = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(1200))
    right = sum(got[i].predicted == labels[i][1] for i in held) / len(held)
    assert right > 0.97
    assert all(got[i].predicted == 1 for i in (5000, 5001, 5002, 5003))
    assert all(got[i].predicted == 0 for i in (5004, 5005, 5006, None)) and got[5005].score == got[5006].score


def test_toxicity_judges_phrases_and_split_words(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(1600):
        words = [rng.choice(WORDS) + rng.choice(WORDS)[:3] for _ in range(rng.randint(8, 60))]
        toxic = i % 5 == 0
        for _ in range(3):
            at = rng.randrange(len(words))
            # "velto" and "gabrin" are ordinary words, only "velto gabrin" is an insult
            words[at:at] = ["velto", "gabrin"] if toxic and i % 2 else ["grobnak"] if toxic else [rng.choice(["velto", "gabrin"])]
        rows.append((i, ". ".join(" ".join(words[k : k + 12]) for k in range(0, len(words), 12))))
        labels.append((i, int(toxic)))
    clean = " ".join(rng.choice(WORDS) + rng.choice(WORDS)[:3] for _ in range(15))
    cases = {9000: "velto gabrin", 9001: "gro bnak", 9002: "grobnak", 9003: "velto", 9004: "gabrin", 9005: "gabrin " + clean + " velto"}
    rows += [(i, f"{clean} {x}. {x} {clean}. {x}") for i, x in cases.items()]
    long = " ".join(rng.choice(WORDS) + rng.choice(WORDS)[:3] for _ in range(300_000))
    rows += [(9006, long), (9007, long + " grobnak" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    got = {r.doc_id: r for r in toxicity(docs, spark.createDataFrame(labels, "doc_id LONG, toxic INT")).collect()}
    held = [i for i in range(1600) if zlib.crc32(str(i).encode()) % 4 == 2]
    for kind in (0, 1):
        ids = [i for i in held if labels[i][1] == kind]
        assert sum(got[i].predicted == kind for i in ids) / len(ids) > 0.95, kind
    assert [got[i].predicted for i in sorted(cases)] == [1, 1, 1, 0, 0, 0]
    assert (got[9006].predicted, got[9007].predicted) == (0, 1)


def test_toxicity_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id LONG, toxic INT")
    assert {r.predicted for r in toxicity(docs, none).collect()} == {0}
    assert toxicity(empty_docs(spark), spark.createDataFrame([Row(doc_id=1, toxic=1)])).count() == 0


def test_pipeline_stages_keep_columns_and_drop_what_they_should(spark, docs, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, "no such words here at all")], "item_id LONG, text STRING").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT").write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in list(stages.items())[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = odd_texts()
    last: dict[str, int] = {}
    for i, t in rows:
        if i is not None:
            n = (t or "").translate(AZ)
            last[n] = max(i, last.get(n, i))
    once = [(i, t) for i, t in rows if i == last.get((t or "").translate(AZ)) or (t or "").translate(AZ) not in last]
    near = components_by_force(once, 5, 4, 5)
    kept = sorted((i for i, _ in once if i is None or near[i] == i), key=lambda i: (i is None, i))
    assert sorted((r.doc_id for r in got.collect()), key=lambda i: (i is None, i)) == kept
