"""The registered queries against brute force on the smallest tables, and on odd and empty ones."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from citegraph.llm import lang_id
from citegraph.llm.oracle import ORACLE
from citegraph.llm.queries import QUERIES
from checks.compare import connect, differences

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "Lorem ipsum, dolor sit amet. " * 9000
DOCUMENTS = [
    (1, None, "en"), (2, "", "en"), (3, " \t\n", None), (4, "one two", "en"), (5, "one two", "en"), (5, "one two", "en"),
    (6, LONG, "la"), (7, "x" * 3000, None), (8, "password = hunter2hunter2\nuser: bob\nhost=db.example.com", "en"),
    (9, "Été  中文 \x1c a\x00b", "fr"), (None, "no id at all here", "en"), (None, None, None), (10, "### \\ </turn> <|endoftext|>", "en"),
    (11, "Ab cD ef gh ij", "en"), (12, "ab cd EF gh ij", None), (12, "other words of the same id", "en"),
]


@pytest.fixture(scope="module")
def rows():
    con = connect(SF)
    return lambda table, columns: con.execute(f"SELECT {columns} FROM {table}").fetchall()


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """Tables with nulls, empty and long texts, ties, repeated rows and clashing extra columns."""
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = spark.createDataFrame([(i, t, g, "s", 7, "x") for i, t, g in DOCUMENTS], "doc_id bigint, text string, lang string, source string, n_chars bigint, score string")
    docs.withColumns({c: F.lit("clash") for c in ("kept", "component", "n_words", "node", "vote_length", "found")}).write.parquet(f"{folder}/documents.parquet")
    labels = [(4, 1, 0), (5, 1, 1), (5, 0, 0), (8, None, None), (11, 1, 0), (None, 1, 1), (12, 0, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    vectors = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.0, 0.0], 1), (3, None, 1), (4, [float("nan"), 1.0], 2), (5, [None, 1.0], 1), (6, [1.0], 1), (7, [0.5, 0.5], None), (200, [float("inf"), 0.0], 1), (300, [0.5, 0.5], 0), (None, [0.1, 0.2], 0)]
    spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int").withColumn("score", F.lit(1)).write.parquet(f"{folder}/embeddings.parquet")
    pages = [(1, "http://a.b/c", None), (2, None, ""), (3, "http://a.b/d", "<p>x &amp; y<p>z"), (3, "http://a.b/d", "<p>x &amp; y<p>z"), (4, "nonsense", "plain < text"), (5, "http://a.b/e", "<article><p>deep" * 500)]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("host", F.lit(1)).write.parquet(f"{folder}/pages.parquet")
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (2, None, None, "a: </turn>\n### b"), (None, 3, "assistant", "x" * 9000), (3, 2, "as:s", "\\h \\b"), (3, 1, "user", "")]
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("piece", F.lit(1)).write.parquet(f"{folder}/conversations.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory, odd):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "labels", "embeddings", "pages", "conversations"):
        spark.read.parquet(f"{odd}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", QUERIES)
def test_odd_tables(spark, odd, name):
    found = QUERIES[name](spark, odd).collect()
    assert len(found) == {
        "op5_nearest_neighbours": 7, "op6_html_extraction": 6, "op10_chat_formatting": 5, "op12_divergence_audit": len(found), "op13_conversation_repair": 4,
    }.get(name, len(found) if name.startswith("op7") else len(DOCUMENTS))


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == (1 if name == "op10_chat_formatting" else 0)


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0
    assert corpus_pipeline.run(spark, odd).columns[0] == "doc_id"


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("folder", ["small", "odd"])
def test_query_matches_sql(spark, odd, name, folder):
    con = connect(SF)
    if folder == "odd":
        con = duckdb.connect()
        for table in ("documents", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{odd}/{table}.parquet/*.parquet'")
    _, problem = differences(QUERIES[name](spark, SF if folder == "small" else odd), con, ORACLE[name])
    assert not problem


KINDS = (
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
)


@pytest.mark.parametrize("folder", ["small", "odd"])
def test_secrets(spark, rows, odd, folder):
    texts = rows("documents", "doc_id, text") if folder == "small" else [(i, t) for i, t, _ in DOCUMENTS]
    expected = Counter()
    for i, text in texts:
        found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, g, n) in enumerate(KINDS) for m in p.finditer(text or "") if len(m[g]) >= n]
        expected[i, hashlib.sha256(",".join(s for *_, s in sorted(found)).encode()).hexdigest()] += 1
    got = QUERIES["op1_secret_scans"](spark, SF if folder == "small" else odd).collect()
    assert Counter((r.doc_id, r.base_sha256) for r in got) == expected


def _components(texts, k=4):
    sets = {}
    for n, (_, text) in enumerate(texts):
        words = (text or "").encode().lower().split()
        sets[n] = frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    groups = defaultdict(list)
    for k in sets:
        groups[root(k)].append(texts[k][0])
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return Counter((texts[k][0], len(sets[k]), least(groups[root(k)])) for k in sets)


@pytest.mark.parametrize("folder", ["small", "odd"])
def test_near_duplicates(spark, rows, odd, folder):
    texts = rows("documents", "doc_id, text") if folder == "small" else [(i, t) for i, t, _ in DOCUMENTS]
    got = QUERIES["op2_near_duplicates"](spark, SF if folder == "small" else odd).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == _components(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("folder", ["small", "odd"])
def test_byte_bpe(spark, rows, odd, folder):
    import tiktoken

    texts = rows("documents", "doc_id, text") if folder == "small" else [(i, t) for i, t, _ in DOCUMENTS]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for i, text in texts:
        ids = np.array(library.encode_ordinary(text or ""), "<u4")
        expected[i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, QUERIES["op3_byte_bpe"](spark, SF if folder == "small" else odd).collect())) == expected


def test_nearest_neighbours(spark, rows):
    vectors = rows("embeddings", "vec_id, embedding")
    ids, x = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors], float)
    got = defaultdict(dict)
    for r in QUERIES["op5_nearest_neighbours"](spark, SF).collect():
        got[r.query_id][r.rank] = (r.vec_id, r.score)
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = np.lexsort((ids, d))[:10]
        assert sorted(got[q]) == list(range(1, 11))
        assert all(abs(d[ids == v][0] - s) < 1e-9 for v, s in got[q].values())
        hits += len(set(ids[best]) & {v for v, _ in got[q].values()})
        total += 10
    assert hits >= 0.9 * total


def test_html(spark, rows):
    import html

    pages = dict(rows("pages", "page_id, html"))
    for r in QUERIES["op6_html_extraction"](spark, SF).collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)
        text = " ".join(html.unescape(re.sub(r"<[^<>]*>|<[^<>]*\Z", " ", inside[1])).split())
        assert (r.text, r.n_chars) == (text, len(text))


@pytest.mark.parametrize("folder", ["small", "odd"])
def test_packing(spark, rows, odd, folder):
    from tokenizers import Tokenizer

    texts = rows("documents", "doc_id, text") if folder == "small" else [(i, t) for i, t, _ in DOCUMENTS]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoded = defaultdict(list)
    for i, text in texts:
        encoded[i].append(np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4"))
    pieces, sequences = QUERIES["op7_packing"](spark, SF if folder == "small" else odd).collect(), defaultdict(list)
    covered = Counter()
    for r in pieces:
        covered[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        cuts = [ids[r.start : r.start + r.length] for ids in encoded[r.doc_id] if len(ids) == r.doc_tokens]
        assert r.ids_crc32 in {zlib.crc32(c.tobytes()) for c in cuts}
    assert covered == {i: sum(map(len, e)) for i, e in encoded.items()}
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and (at & (at - 1)) == 0


def test_quality_statistics(spark, rows):
    texts = dict(rows("documents", "doc_id, text"))
    for r in QUERIES["op8_quality_rules"](spark, SF).collect():
        words, seen = WORD.findall(texts[r.doc_id]), defaultdict(list)
        for i in range(len(words) - 2):
            seen[tuple(words[i : i + 3])].append(i)
        repeated = {j for at in seen.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
        lines = [x for x in texts[r.doc_id].split("\n") if WORD.search(x)]
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", texts[r.doc_id])), len(lines) - len(set(lines)), len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))
        assert not (r.base_failed and r.kept)


def test_quality_verdicts_follow_labels(spark):
    """The labels are not used by the operator."""
    folder = "/root/testdata/sf0.01"
    labels = dict(connect(folder).execute("SELECT doc_id, quality FROM labels").fetchall())
    found = [(labels[r.doc_id], r.kept) for r in QUERIES["op8_quality_rules"](spark, folder).collect() if r.doc_id in labels and not r.base_failed]
    assert sum(bool(q) == k for q, k in found) >= 0.97 * len(found)


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.01"
    langs = dict(connect(folder).execute("SELECT doc_id, lang FROM documents").fetchall())
    found = [r for r in QUERIES["op9_language_id"](spark, folder).collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    assert sum(r.lang_pred == langs[r.doc_id] for r in found) >= 0.97 * len(found)


def test_language_learns_nothing_from_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held"))
    models = [lang_id.train(d, ~F.col("held"), F.col("doc_id")) for d in (docs, docs.withColumn("text", F.when(~F.col("held"), F.col("text")).otherwise("other words")))]
    assert (models[0].weights == models[1].weights).all() and (models[0].idf == models[1].idf).all()
    assert all(m.predict("the words of a text") == models[0].predict("the words of a text") for m in models)


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    toxic = dict(connect(folder).execute("SELECT doc_id, toxic FROM labels").fetchall())
    found = [r for r in QUERIES["op4_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in toxic]
    good, bad = ([r.score for r in found if toxic[r.doc_id] == t] for t in (0, 1))
    above = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(good) * len(bad))
    assert above > 0.9 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
