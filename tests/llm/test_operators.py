"""Operators on small fixtures, by their general interfaces."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citegraph.llm import byte_bpe, chat, lang_id, near_dups, packing, rotated_codes, secrets, site_tree, toxicity

RANKS = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def kinds(text):
    return [(k, text[s:e]) for k, s, e in secrets.scan(text)]


def test_weak_parts_need_their_complement():
    opaque = "Zk3fQ9xTb7LmW2pR8vYc"
    assert kinds(f"see {opaque} there") == []
    assert kinds(f"user: bob then {opaque}") == [("ident", "bob"), ("opaque", opaque)]
    assert kinds(f"user: bob\n\n{opaque}") == []
    assert kinds(f"user: bob {'word ' * 80}{opaque}") == []
    assert kinds("user: bob") == [] and kinds("https://db.example.com/x") == []
    assert kinds(f"https://db.example.com/x {opaque}") == [("opaque", opaque)]
    whole = kinds(f"https://db.example.com/x user: bob {opaque}")
    assert [k for k, _ in whole] == ["endpoint", "ident", "opaque"]
    assert [k for k, _ in kinds(f"AKIA{'A' * 16} {opaque}")] == ["access", "opaque"]


def test_long_parts_reach_beyond_short_ones_inside_them():
    inside = f"token={'a1' * 12}.{'x' * 280}"
    found = kinds(f"{inside} user: bob12")
    assert [k for k, _ in found] == ["assign", "hex", "ident"]
    runs = ".".join(["0123456789abcdef01234567"] * 3)
    covered = f"user: bob secret={runs}.Zk3fQ9xTb7LmW2pR8vYc"
    assert [k for k, _ in kinds(covered)] == ["ident", "assign", "hex", "hex", "hex"]


def linked_pair_by_pair(text):
    """Weak parts and links held against every part, without sorting."""
    low = text.lower()
    strong = secrets.strong_parts(text, low)
    weak = secrets.weak_parts(text, low, strong)
    every = [*strong, *weak]
    assert not [1 for i, w in enumerate(weak) for o in (*strong, *weak[:i]) if w[0] < o[1] and o[0] < w[1]]
    breaks = [m.end() for m in secrets.BLANK_LINE.finditer(text)]
    part = lambda at: sum(b <= at for b in breaks)

    def near(p, kinds):
        gap = lambda o: o[0] - p[1] if o[0] >= p[0] else p[0] - o[1]
        return any(o is not p and o[2] in kinds and gap(o) <= secrets.REACH and part(o[0]) == part(p[0]) for o in every)

    names, values, places = ("access", "ident"), ("assign", "hex", "opaque"), ("endpoint",)
    needed = {
        "opaque": lambda p: near(p, names) or near(p, places),
        "ident": lambda p: near(p, values),
        "endpoint": lambda p: near(p, names) and near(p, values),
    }
    kept = [*strong, *(p for p in weak if needed[p[2]](p))]
    return sorted((k, s, e) for s, e, k in kept)


def test_links_equal_those_of_all_pairs():
    own = np.random.default_rng(5)
    pieces = ["user: bob12", "token=" + "a1" * 12 + ".tail", "0123456789abcdef01234567", "Zk3fQ9xTb7LmW2pR8vYc", "https://db.example.com/x",
              "AKIA" + "B" * 16, "word " * 30, "y" * 150, "\n\n", "host=db.example", "secret=" + "q7" * 90, "."]
    for _ in range(400):
        text = "".join(pieces[i] + (" ", "", "\n")[own.integers(3)] for i in own.integers(0, len(pieces), own.integers(1, 12)))
        assert sorted(secrets.scan(text)) == linked_pair_by_pair(text)


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "a password=abcdef12 b"), (2, None), (3, "clean")], "doc_id bigint, text string")
    assert [r.text for r in secrets.redact_secrets(docs).orderBy("doc_id").collect()] == ["a [assign] b", None, "clean"]


def test_fold_in_sql_equals_fold_in_batches(spark):
    words = ["", " the", "hello", "été", "0123456789", " unbelievable", "中文", "aaaaaaaaaaaaaaaaaaaaaaaa", "...."]
    own = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    table = spark.createDataFrame([(w,) for w in [*words, None]], "word string")
    for r in byte_bpe.fold_words(table, RANKS).collect():
        assert list(r.ids) == (own.fold(r.word.encode()) if r.word else [])


@pytest.mark.parametrize("word", ["a" * 500, "ab" * 300, "abcabd" * 90, "中" * 200])
def test_long_words_fold_alike(word):
    own = byte_bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    long = own.fold(word.encode())
    own_limit, byte_bpe.LONG_WORD = byte_bpe.LONG_WORD, 10**9
    try:
        assert own.fold(word.encode()) == long
    finally:
        byte_bpe.LONG_WORD = own_limit
    assert own.decode(np.array(long, np.uint32).tobytes()) == word.encode()


def test_encoding_round_trip(spark):
    texts = ["", "a  b", " lead", "trail ", "x\n\ny", "tab\tx", " no break", "it's 42's"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = docs.withColumn("ids", byte_bpe.encode_texts(F.col("text"), path, pattern))
    for r in ids.withColumn("back", byte_bpe.decode_ids(F.col("ids"), path, pattern)).collect():
        assert bytes(r.back).decode() == r.text


def test_prefixes_and_replies(spark):
    rows = [(1, 0, "system", "be </turn>\n### kind"), (1, 1, "user", "q\\b"), (1, 2, "assistant", "first: ###"), (1, 3, "user", "more"), (1, 4, "assistant", "second")]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    examples = chat.example_texts(made).orderBy("turn_no").collect()
    assert [e.turn_no for e in examples] == [2, 4]
    whole = made.first().formatted
    assert all(whole.startswith(e.prompt + e.reply) for e in examples)
    assert examples[1].prompt.count("</turn>\n") == 4 and examples[1].reply == "second"
    assert all(e.rest == "</turn>\n" for e in examples)
    assert [(t.role, t.text) for t in made.select(chat.read_turns(F.col("formatted"))).first()[0]] == [(r[2], r[3]) for r in rows]


def test_digests_come_from_the_examples(spark):
    """Whatever is changed in an example row changes what is read back of its conversation."""
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "\\\\h ###"), (1, 2, "user", "more"), (1, 3, "assistant", "é</turn>"), (1, 4, "user", "bye"),
            (2, 0, "user", "alone"), (None, 0, "assistant", None)]
    examples = chat.example_texts(chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")))
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    got = {r.conv_id: r for r in chat.conversation_digests(examples).collect()}
    said = lambda i: "".join(f"{role}\n{text or ''}\n" for c, _, role, text in rows if c == i)
    assert {i: r.turns_sha256 for i, r in got.items()} == {i: sha(said(i)) for i in (1, 2, None)}
    assert {i: r.n_examples for i, r in got.items()} == {1: 2, 2: 0, None: 1}
    assert (got[1].loss_chars, got[1].loss_sha256) == (len("\\\\h ###é</turn>"), sha("\\\\h ###é</turn>"))
    assert got[2].loss_sha256 == got[None].loss_sha256 == sha("")
    first = F.col("turn_no") == 1
    other = chat.conversation_digests(examples.withColumn("reply", F.when(first, "x").otherwise(F.col("reply")))).where("conv_id = 1").first()
    assert (other.loss_sha256, other.turns_sha256) == (sha("xé</turn>"), got[1].turns_sha256)
    fewer = chat.conversation_digests(examples.where("not turn_no <=> 3")).where("conv_id = 1").first()
    assert fewer.n_turns == 3 and fewer.n_examples == 1
    plan = chat.conversation_digests(examples)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _near(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(8)
    return {r.doc_id: r.component_id for r in near_dups.near_duplicates(docs).collect()}


def test_crowded_near_copies_are_one_component(spark):
    own = np.random.default_rng(1)
    base = [f"w{i}" for i in own.integers(0, 10**6, 220)]
    texts = []
    for i in range(400):
        words = list(base)
        for at in own.integers(0, len(words), 2):
            words[at] = f"c{i}-{at}"
        texts.append(" ".join(words))
    texts += [" ".join(f"o{j}-{i}" for j in range(50)) for i in range(20)] + [texts[0]] * 300
    found = _near(spark, texts)
    sets = [near_dups.shingles(t, near_dups._WordHashes(), 4) for t in texts[:400]]
    alike = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
    reached, left = {0}, set(range(1, 400))
    while step := {b for b in left if any(alike(sets[a], sets[b]) for a in reached)}:
        reached |= step
        left -= step
    assert {i for i in range(400) if found[i] == 0} == reached
    assert all(found[i] == i for i in range(400, 420)) and all(found[i] == 0 for i in range(420, 720))


def test_chain_of_near_copies(spark):
    """Each text is a copy of the one before with a few words changed; only neighbours are alike."""
    texts, words = [], [f"w{i}" for i in range(300)]
    for i in range(60):
        words = list(words)
        for k in range(5):
            words[(i * 5 + k) % 300] = f"n{i}-{k}"
        texts.append(" ".join(words))
    assert set(_near(spark, texts).values()) == {0}


def test_neighbours_among_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(0, 1200)] + [(5000 + i, [float(i % 7), 1.0, 0.0, 2.0]) for i in range(300)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = rotated_codes.neighbours(vectors, F.col("vec_id") % 100 == 0).collect()
    assert {r.query_id for r in found} == {*range(0, 1200, 100), 5000, 5100, 5200}
    assert sorted(r.vec_id for r in found if r.query_id == 0) == list(range(1, 11))
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 1100] == list(range(10))


def test_neighbours_among_many_cells(spark):
    """Vectors without clusters in 50 cells: the neighbours of a query lie in most of them."""
    x = np.random.default_rng(17).standard_normal((40_000, 32)).astype(np.float32)
    table = pa.table({"vec_id": pa.array(range(len(x))), "embedding": pa.array(list(x), pa.list_(pa.float32()))})
    found = rotated_codes.neighbours(spark.createDataFrame(table), F.col("vec_id") % 400 == 0).collect()
    near = {}
    for r in found:
        near.setdefault(r.query_id, set()).add(r.vec_id)
    gaps = rotated_codes.squared(x[::400].astype(float), x.astype(float))
    true = {400 * i: set(np.argsort(g)[:11].tolist()) - {400 * i} for i, g in enumerate(gaps)}
    assert sum(len(near[i] & true[i]) for i in true) >= 0.99 * 10 * len(true)


def test_blocks_hold_small_cells_and_parts_of_large_ones():
    first, dealt, blocks = rotated_codes.blocks_of(np.array([10_000, 5000, 2000, 40_000, 0, 7]))
    assert (first.tolist(), dealt.tolist(), blocks) == ([0, 0, 1, 2, 5, 5], [1, 1, 1, 3, 1, 1], 6)


def test_bounds_hold():
    own = np.random.default_rng(3)
    x, q = own.standard_normal((500, 64)), own.standard_normal((20, 64))
    centre, turn = x.mean(0), rotated_codes.rotation(64)
    low, high = rotated_codes.bounds(*rotated_codes.encode(x, centre, turn), q, centre, turn)
    true = rotated_codes.squared(q, x)
    assert ((low <= true + 1e-6) & (true <= high + 1e-6)).mean() > 0.99


def test_repeated_unmarked_branches_are_removed(spark):
    page = "<body><div><p>Menu one</p></div><section><p>Story {0} of its own</p>{1}</section></body>"
    rows = [(i, f"http://h.example/{i}", page.format(i, "<p>more words</p>" * (i % 5))) for i in range(12)]
    rows += [(100 + i, "http://alone.example/", page.format(1, "")) for i in range(12)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in site_tree.main_text(pages).collect()}
    assert found[3] == "Story 3 of its own more words more words more words"
    assert found[100] == "Menu one Story 1 of its own"  # one page, however often it is there


@pytest.mark.parametrize("most", [site_tree.BROADCAST_MAX_ROWS, 0])
def test_boilerplate_that_no_list_names(spark, monkeypatch, most):
    """Thirty pages with a bar and links under classes that say nothing, and page numbers in both."""
    monkeypatch.setattr(site_tree, "BROADCAST_MAX_ROWS", most)
    words = "amber birch cedar delta ember fjord grove heath islet jetty".split()
    body = "<div class='topbar'>Page {0} of 30<p>Our <b>shop</b> {0}</p></div><div class='story'><h1>{1}</h1>{2}<p>2024</p><p class='n'>{0}</p></div><ul class='foot-links'><li>Page {0}<li>About us</ul>"
    own = np.random.default_rng(1)
    rows, said = [], {}
    for i in range(30):
        told = [" ".join(own.choice(words, 8)) for _ in range(2 + i % 4)]
        rows.append((i, "http://h.example/x", body.format(i, told[0], "".join(f"<p>{t}</p>" for t in told[1:]))))
        said[i] = " ".join([*told, "2024", str(i)])
    rows += [(100 + i, f"http://other{i}.example/", "<div class='topbar'>Page 1 of 30</div>") for i in range(9)]
    rows += [(200, None, None), (201, "", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in site_tree.main_text(pages).collect()}
    assert len(found) == len(rows)
    for i, text in said.items():
        assert found[i] == text
    # one page of a host is no boilerplate
    assert all(found[100 + i] == "Page 1 of 30" for i in range(9)) and found[200] == found[201] == ""


def test_importance_is_that_of_a_plain_tree(spark):
    from collections import Counter
    from math import log

    body = "<div><p>same</p>{0}</div><section>{1}<p>tail</p></section>"
    pages = [body.format("<p>x</p>" * (i % 2), f"word{'abcdef'[i]}") for i in range(6)]
    rows = spark.createDataFrame([(i, "http://h/", p) for i, p in enumerate(pages)], "page_id int, url string, html string")
    found = sorted(round(r.importance, 9) for r in site_tree.node_importance(site_tree.parse_pages(rows)).collect())
    even = lambda seen: (log(len(seen)) - sum(n * log(n) for n in Counter(seen).values()) / len(seen)) / log(len(seen))
    mixed = lambda looks, inside: (1 - site_tree.GAMMA ** len(set(looks))) * even(looks) + site_tree.GAMMA ** len(set(looks)) * inside
    half = [i % 2 for i in range(6)]  # pages with a second p in the div
    contents = {"div/p": even(half), "section": even(range(6)), "section/p": 0.0}
    inside = lambda *of: sum(contents[c] for c in of) / len(of)
    expected = [
        mixed([0] * 6, inside(*contents)),  # the root holds a div and a section
        mixed(half, inside("div/p")),
        mixed(half, contents["div/p"]),
        mixed([0] * 6, inside("section", "section/p")),
        mixed([0] * 6, contents["section/p"]),
    ]
    assert found == sorted(round(e, 9) for e in expected)


def test_deep_pages_have_bounded_trees():
    page = "".join(f"<div>{i} a" for i in range(5000))
    blocks, nodes = site_tree.read_page(page)
    assert [t for _, t in blocks] == [f"{i} a" for i in range(5000)]
    assert len(nodes) == site_tree.DEPTH and max(len(above) for above, _ in nodes.values()) == site_tree.DEPTH


def test_blocks_of_a_page():
    read = lambda page: [t for _, t in site_tree.read_blocks(page)]
    assert read("<p>a<b>b</b>c<p>d<br>e") == ["abc", "d e"]
    assert read("<nav>x<div>y</div></nav><p title='a>b'>t</p><!-- <p>c --><script>'<p>s</p>'</script>u") == ["t", "u"]
    assert read("<article><header><h1>T</h1></header><p>x<div class='comments'><p>c</div></article><header>h</header>") == ["T", "x"]
    assert read("a &lt; b &am") == ["a < b &am"] and read("cut <p") == ["cut"]
    assert read("1 < 2 <em>and</em> 3 > 2") == ["1 < 2 and 3 > 2"]


def test_one_word_of_a_class_does_not_drop_an_article():
    read = lambda page: [t for _, t in site_tree.read_blocks(page)]
    article = "<p>lead</p><article><p>text</p></article>"
    for start, end in (("<div class='layout has-sidebar'>", "</div>"), ("<div class='no-sidebar'>", "</div>"), ("<div id='search-results'>", "</div>"), ("<div class='sidebar'>", "</div>"), ("<form action='/x'>", "</form>")):
        assert read(start + article + "<nav>menu</nav>" + end) == ["lead", "text"], start
    inside = "<article><div class='social-science'>a</div><p class='legal'>b</p><p class='share-enabled'>c</p><div class='ad'>d</div></article>"
    assert read(inside) == ["a", "b", "c"]
    assert read("<article>x</article><div class='related'><article>y</article></div><form>z</form><p class='ad-2'>v") == ["x"]
    assert read("<nav><article>x</article></nav><div class='legal'>y</div>z") == ["z"]


def test_shards_pack_whole():
    own = np.random.default_rng(5)
    tails = [own.integers(0, 500, n).astype(np.uint32) for n in own.integers(1, 1024, 300)]
    sequences = list(packing.pack_shard(tails, np.ones(500, np.float32), 400.0))
    taken = sorted((i, s, n) for q in sequences for i, s, n in q)
    for i, t in enumerate(tails):
        at = 0
        for _, s, n in (x for x in taken if x[0] == i):
            assert s == at
            at += n
        assert at == len(t)
    lengths = [sum(n for *_, n in q) for q in sequences]
    assert lengths.count(1024) == sum(map(len, tails)) // 1024 and all(n & (n - 1) == 0 for n in lengths)


def test_related_tails_share_windows():
    topics = [np.full(300, k, np.uint32) for k in (7, 8, 9)]
    sequences = list(packing.pack_shard([topics[i % 3] for i in range(9)], np.ones(500, np.float32), 300.0))
    assert {i % 3 for i, *_ in sequences[0][:3]} == {0}


def test_temperature_keeps_scores_of_separable_texts_apart():
    own = np.random.default_rng(8)
    labels = own.integers(0, 3, 200)
    scores = np.eye(3)[labels] * own.uniform(0.5, 3, 200)[:, None]
    t = lang_id.fit_temperature(scores, labels)
    sure = lang_id.softmax(scores / t).max(1)
    assert 0.02 < t < 1 and (scores.argmax(1) == labels).all() and len(set(sure)) == 200 and sure.max() < 1
    # overconfident scores with every fifth label wrong are cooled
    wrong = np.where(np.arange(200) % 5 == 0, (labels + 1) % 3, labels)
    assert lang_id.fit_temperature(np.eye(3)[labels] * 10, wrong) > 2
    assert lang_id.fit_temperature(np.empty((0, 3)), np.empty(0, np.int64)) == 1.0 == lang_id.fit_temperature(np.zeros((4, 1)), np.zeros(4, np.int64))


def test_follow_the_leader_is_the_plain_rule():
    """The per-coordinate sums of gradients and their closed-form weights, one coordinate at a time."""
    own, k = np.random.default_rng(9), 3
    model, z, n = lang_id.FollowTheLeader(k), {}, {}

    def weight(at, c):
        held = z.get((at, c), 0.0)
        if abs(held) <= lang_id.L1:
            return 0.0
        return -(held - np.sign(held) * lang_id.L1) / ((lang_id.BETA + n.get((at, c), 0.0) ** 0.5) / lang_id.ALPHA + lang_id.L2)

    for _ in range(40):
        slots = own.choice(12, 4, replace=False)
        x, label = own.uniform(0, 1, 4), int(own.integers(k))
        model.learn(slots, x, label)
        at, value = [*slots.tolist(), lang_id.SLOTS], [*x.tolist(), 1.0]
        raw = [np.exp(sum(v * weight(a, c) for a, v in zip(at, value, strict=True))) for c in range(k)]
        steps = []
        for a, v in zip(at, value, strict=True):
            for c in range(k):
                g = v * (raw[c] / sum(raw) - (c == label))
                before = n.get((a, c), 0.0)
                steps.append((a, c, g - ((before + g * g) ** 0.5 - before**0.5) / lang_id.ALPHA * weight(a, c), g * g))
        for a, c, dz, dn in steps:
            z[a, c], n[a, c] = z.get((a, c), 0.0) + dz, n.get((a, c), 0.0) + dn
    for a in [*range(12), lang_id.SLOTS]:
        assert model.weights(a) == pytest.approx([weight(a, c) for c in range(k)])


def test_document_frequencies_count_texts(spark):
    from collections import Counter

    texts = ["the day was warm", "warm warm", "", None, "día de niñas", "the day was warm"]
    found, n = lang_id.document_frequencies(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    plain = Counter(int(s) for t in texts for s in set(lang_id.gram_counts(t or "")[0].tolist()))
    assert n == len(texts) and {int(s): int(found[s]) for s in np.flatnonzero(found)} == plain


def test_sequences_of_letters():
    codes = toxicity.sequences("Ab, c")
    bits, mask = toxicity.BITS, (1 << toxicity.BITS) - 1
    text = ["".join(chr(k >> bits * j & mask) if k >> bits * j & mask else "_" for j in range(4, -1, -1)) for k in codes.tolist()]
    assert text == ["____a", "___ab", "__ab_", "_ab_c", "ab_c_"]
    assert len(toxicity.sequences("")) == len(toxicity.sequences("1, 2!")) == 0
    # letters of other scripts are neither separators nor letters of this one
    assert len({tuple(toxicity.sequences(c).tolist()) for c in ("a", "\u0461", "\u0400", "\u0800", "\u4e00")}) == 5
    assert len(toxicity.sequences("\u4000\u0400\U00020000")) == 4


def test_smoothing_equals_a_plain_kneser_ney(spark):
    from collections import Counter
    from math import log

    d, k = toxicity.DISCOUNT, toxicity.ORDER
    texts = {1: ["you rotten old toad", "rotten eggs", "a toad you are"], 0: ["the old road is long", "you are on the road", "", "eggs and toast"]}
    letters = {c: [] for c in texts}
    for c, said in texts.items():
        for t in said:
            padded = "_" * (k - 1) + t.replace(" ", "_") + "_"
            letters[c] += [padded[i : i + k] for i in range(len(padded) - k + 1)] if t else []
    count = {c: Counter(found) for c, found in letters.items()}
    orders, longer = {}, set(letters[0]) | set(letters[1])
    for n in range(k - 1, 0, -1):
        orders[n] = Counter(g[1:] for g in longer)
        longer = set(orders[n])

    def shared(g):
        if not g:
            return 1 / toxicity.ALPHABET
        beside = [n for h, n in orders[len(g)].items() if h[:-1] == g[:-1]]
        return (max(orders[len(g)][g] - d, 0) + d * len(beside) * shared(g[1:])) / sum(beside)

    def chance(c, g):
        beside = [n for h, n in count[c].items() if h[:-1] == g[:-1]]
        return (max(count[c][g] - d, 0) + d * len(beside) * shared(g[1:])) / sum(beside) if beside else shared(g[1:])

    rows = [(t, c) for c, said in texts.items() for t in said]
    counts = toxicity.count_sequences(spark.createDataFrame(rows, "text string, toxic int"))
    packed = lambda g: sum((0 if c == "_" else ord(c)) << toxicity.BITS * i for i, c in enumerate(reversed(g)))
    counted = {r.sequence: (r.n_toxic, r.n_ordinary) for r in counts.collect()}
    seen = set(count[0]) | set(count[1])
    assert counted == {packed(g): (count[1][g], count[0][g]) for g in seen}
    by_sequence, by_context = ({r.key: r.gain for r in part.collect()} for part in toxicity.smooth(counts))
    assert by_sequence == pytest.approx({packed(g): log(chance(1, g) / chance(0, g)) for g in seen})
    # all letters after a context have a chance of one together, but for those never seen at all
    back = lambda c, x: d * sum(h[:-1] == x for h in count[c]) / n if (n := sum(m for h, m in count[c].items() if h[:-1] == x)) else 1.0
    assert by_context == pytest.approx({packed(x): log(back(1, x) / back(0, x)) for x in {g[:-1] for g in seen}})


def test_the_scoring_model_counts_every_labelled_row(spark, monkeypatch):
    rows = [(i, f"the day {i} was warm", 0) for i in range(40)] + [(100 + i, f"you rotten scoundrel {i}", 1) for i in range(40)]
    training = spark.createDataFrame([*rows, (999, "unlabelled words", None)], "row bigint, text string, toxic int")
    kept, smooth = [], toxicity.smooth
    monkeypatch.setattr(toxicity, "smooth", lambda counts: kept.append(counts) or smooth(counts))
    toxicity.toxicity_scores(training.select("text"), training).collect()
    total = lambda counts: tuple(counts.agg(F.sum("n_toxic"), F.sum("n_ordinary")).first())
    every = total(toxicity.count_sequences(training.where("toxic is not null")))
    assert total(kept[-1]) == every and all(a < b for a, b in zip(total(kept[0]), every, strict=True))


def test_toxic_words_raise_scores(spark):
    rows = [(i, f"the day {i} was warm and quiet", 0) for i in range(300)] + [(1000 + i, f"you rotten scoundrel day {i}", 1) for i in range(100)]
    docs = spark.createDataFrame(rows, "row bigint, text string, toxic int")
    asked = spark.createDataFrame([(1, "such a rotten scoundrel"), (2, "a warm and quiet day"), (3, None)], "doc_id bigint, text string")
    score = {r.doc_id: r.score for r in toxicity.toxicity_scores(asked, docs).collect()}
    assert score[1] > 0.7 > 0.5 > score[2] and 0 <= score[3] <= 1


def test_every_sequence_keeps_its_gain(spark):
    """Keys that agree modulo 4,000,037, which once were the slots of the model."""
    keys = [7 + 4_000_037 * i for i in range(5)]
    table = toxicity.sorted_gains(spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], "key bigint, gain double"))
    seen, gain = toxicity._look_up(np.array([*keys, 8]), table)
    assert seen.tolist() == [True] * 5 + [False] and gain[:5].tolist() == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_joined_model_scores_like_the_broadcast_one(spark, monkeypatch):
    rows = [(i, f"the day {i} was warm and quiet", 0) for i in range(300)] + [(1000 + i, f"you rotten scoundrel day {i}", 1) for i in range(100)]
    training = spark.createDataFrame(rows, "row bigint, text string, toxic int")
    texts = ["such a rotten scoundrel", "a warm and quiet day", None, "", "zzz qqq", "such a rotten scoundrel"]
    asked = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, extra string")
    scores = []
    for most in (toxicity.BROADCAST_KEYS, 0):
        monkeypatch.setattr(toxicity, "BROADCAST_KEYS", most)
        scores.append([(r.doc_id, r.text, r.extra, pytest.approx(r.score)) for r in toxicity.toxicity_scores(asked, training).orderBy("doc_id").collect()])
    assert [r[:3] for r in scores[0]] == [r[:3] for r in scores[1]] == [(i, t, "x") for i, t in enumerate(texts)]
    assert all(a[3].expected == b[3] for a, b in zip(*scores, strict=True))
