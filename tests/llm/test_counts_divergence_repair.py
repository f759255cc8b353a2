"""Token counts, divergence and repair against plain versions, on odd texts and cut at every seam."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citegraph.llm import divergence, repair, token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD_TEXTS = [
    None, "", " \t\n", "a" * 5000, "Don't we'll it'S I'm ' s", "<|endoftext|>", "x<|startoftext|><|endoftext|>y <|endof", "ÀÉ naïve ﬁ ½ ² ª µ ſ ẞ ǅ",
    "é ́x İstanbul ΣΑΣ ς", "中文 字 かな 한국어하", "a b c　d\x1ce\x85f g", "١٢٣ 0९ Ⅷ x²", "👩‍👩‍👧 🇩🇪 ퟿", "\x00\x01 \x7f",
    "word, word; WORD!  word\r\n\tword\x0b\x0c", "—“quoted”… ‐‧",
]


def _random_texts(n):
    draw = random.Random(5)
    pool = "aB'sdtre vmlL9 .,!?\n\té́ßİ中½٣\x1c\xa0—𝔘"
    return ["".join(draw.choices(pool, k=draw.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 200, token_counts.BLOCK_BYTES])
def test_token_counts_are_the_librarys(spark, monkeypatch, block):
    texts = ODD_TEXTS + _random_texts(400) * 2
    rows = [(i % 90, t, "kept") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string").repartition(3)
    library = Tokenizer.from_file(PATH)
    expected = Counter((i, w, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, w in rows)
    monkeypatch.setattr(token_counts, "BLOCK_BYTES", block)
    assert Counter(map(tuple, token_counts.token_counts(docs, PATH).collect())) == expected


def test_packed_numbers_return():
    import numpy as np

    values = np.array([0, 1, 127, 128, 16383, 16384, 1 << 40, (1 << 62) + 5])
    assert token_counts.unpacked(token_counts.packed(values)).tolist() == values.tolist()
    assert token_counts.unpacked(token_counts.packed(values[:0])).tolist() == []


def _divergences(rows, top):
    """Every term of a language in every source, one by one."""
    import re

    cut = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    df, n = Counter(), defaultdict(Counter)
    for lang, source, terms in cut:
        df.update({(lang, t) for t in terms})
        n[lang, source].update(terms)
    kept = defaultdict(list)
    for (lang, t), k in df.items():
        if k >= 3:
            kept[lang].append(t)
    p, whole = {}, {}
    for (lang, source), counts in n.items():
        v, total = len(kept[lang]), sum(counts[t] for t in kept[lang])
        p[lang, source] = {t: 1 + 10**9 * (counts[t] + 1) // (total + v) for t in kept[lang]}
    for lang, terms in kept.items():
        sums = {t: sum(c[t] for (g, _), c in n.items() if g == lang) for t in terms}
        whole[lang] = {t: 1 + 10**9 * (sums[t] + 1) // (sum(sums.values()) + len(terms)) for t in terms}
    f = lambda a, b: (a - b) ** 2 // b
    found = set()
    for lang, source in n:
        pairs = [(-sum(f(x, p[lang, other][t]) for t, x in p[lang, source].items()), other.encode(), other) for g, other in n if g == lang and other != source]
        terms = [(-f(x, whole[lang][t]), t.encode(), t) for t, x in p[lang, source].items() if n[lang, source][t] and x > whole[lang][t]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            found |= {(lang, source, part, item, -value, k) for k, (value, _, item) in enumerate(items, 1)}
    return found


@pytest.mark.parametrize("entries, rows_at_once", [(20, 1), (10**6, 10**5)])
def test_divergence_is_exact(spark, monkeypatch, entries, rows_at_once):
    for name, value in (("BLOCK_ENTRIES", entries), ("CHUNK_ROWS", rows_at_once), ("CHUNK_PAIRS", rows_at_once)):
        monkeypatch.setattr(divergence, name, value)
    draw = random.Random(8)
    words = ["Éa", "b", "ab", "中文", "zZ", "q", "ß", "İ"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(draw.choices(words, k=draw.randint(0, 30))), draw.choice(["en", "de", None]), draw.choice(["s1", "s2", "s3", None])) for _ in range(120)]
    rows += [("rare words", "xx", "alone"), (None, "xx", "silent"), ("", None, "silent"), ("b b b b", "en", "short"), ("1 2 3", "en", "numbers")]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("terms", F.lit(1))
    got = {tuple(r) for r in divergence.divergence_audit(docs.repartition(3), top_terms=5).collect()}
    assert got == _divergences(rows, 5)


def _cheapest(rows):
    """Least (cost, audit) by states, row by row; the audit decides among equal costs."""
    seen, counts, initials = set(), Counter(), []
    best = {0: (0, "", ())}

    def inserts(best):
        for _ in range(2):
            for s, (cost, audit, lines) in list(best.items()):
                to = 2 if s == 2 - 1 or s in (0, 3) else 3
                made = (cost + 2, audit + "I", (*lines, ("user" if to == 2 else "assistant") + ":"))
                best[to] = min(best.get(to, made), made)
        return best

    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        counts[fault] += 1
        if initials and initials[-1] + role[:1] not in ("su", "ua", "au"):
            counts["illegal"] += 1
        initials.append(role[:1])
        after = {}
        for s, (cost, audit, lines) in inserts(best).items():
            to, more = (3 if s == 2 else 2), int(fault == "truncated")
            options = [(s, (cost + 3, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                options.append((to, (cost + 2 + more, audit + "R", (*lines, ("user:" if to == 2 else "assistant:") + text))))
                stays = 1 if s == 0 and role[:1] == "s" else to if role[:1] == "?sua"[to] else 0
                if stays:
                    options.append((stays, (cost + more, audit + "K", (*lines, f"{role}:{text}"))))
            for t, made in options:
                after[t] = min(after.get(t, made), made)
        best = after
    cost, audit, lines = min(v for s, v in inserts(best).items() if s in (0, 3))
    return (*(counts[c] for c in ("blank", "duplicate", "truncated", "illegal")), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.fixture(scope="module")
def conversations():
    draw = random.Random(3)
    rows = []
    for conv in [None, *range(1, 40)]:
        for turn in range(draw.choice([1, 2, 3, 5, 8, 30])):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "using"])
            rows.append((conv, draw.choice([turn, turn, turn, None]), role, draw.choice(["Hi.", "Yes!", "cut", " \n", "", f"t{turn}.", f"u{turn}? ", "ends.\n"])))
    return rows


@pytest.mark.parametrize("block", [1, 2, 3, 7, repair.BLOCK_ROWS])
def test_repair_is_the_least_of_the_cheapest(spark, conversations, block):
    turns = spark.createDataFrame(conversations, "conv_id long, turn int, role string, text string").withColumn("block", F.lit("x"))
    got = repair.conversation_reports(repair.repaired_parts(turns.repartition(3), block)).collect()
    by_id = defaultdict(list)
    for conv, turn, role, text in sorted(conversations, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
        by_id[conv].append((role, text))
    assert {r.conv_id: tuple(r)[1:] for r in got} == {conv: _cheapest(rows) for conv, rows in by_id.items()}
    assert len(got) == len(by_id)


def test_repair_when_rows_fill_their_blocks(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in range(3) for t in range(4)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    for block in (2, 4, 6, 12):
        got = repair.conversation_reports(repair.repaired_parts(turns, block)).collect()
        assert [r.audit for r in got] == ["KKKK"] * 3
