"""The registered queries against brute force, on hand-made rows with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tileplan.llm import mixing, pseudonyms
from tileplan.llm.queries import PSEUDONYM_KEY, QUERIES, TOKENIZER

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, copies INT, id STRING, key STRING"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 5000, n))


def near(text, at):
    words = text.split()
    words[at] = "changed"
    return " ".join(words)


BASE, SHARED = prose(1, 120), prose(2, 130)
TEXTS = [
    BASE, BASE, near(BASE, 3), near(BASE, 110), near(near(BASE, 3), 110), BASE.upper(), prose(3, 60), None, "", "  \n ", "one two",
    "One TWO", "a b c d e f " * 20, f"{prose(4, 40)}\n{SHARED}\n{prose(5, 40)}", f"{prose(6, 30)} {SHARED}", "é" * 900, "x" * 450,
    prose(7, 4000), "line of words\nline of words\n\n# * $ % & |", "Write to anna.bell@example.com or call +1 202 555 0143 today.",
    "Mail anna.bell@example.com, card 4111 1111 1111 1111, born 1984-02-29, from 192.168.10.7 please.", *[prose(20 + k, 30) for k in range(12)],
]
ROWS = [(k, t, ["en", "fr", None][k % 3], ["a", "b", None, "a"][k % 4], len(t or ""), 1, "i", "k") for k, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("rows"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("none"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "vec_id LONG, embedding ARRAY<FLOAT>, label INT").write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], "page_id LONG, url STRING, html STRING").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([], "conv_id LONG, turn LONG, role STRING, text STRING").write.parquet(f"{folder}/conversations.parquet")
    return folder


def rows(spark, name, sf):
    return QUERIES[name](spark, sf).collect()


def test_repeats(spark, sf):
    raw = [(t or "").encode() for t in TEXTS]
    seen = Counter(b[i:i + 400] for b in raw for i in range(len(b) - 399))
    want = {}
    for k, b in enumerate(raw):
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - 399):
            if seen[b[i:i + 400]] > 1:
                gone[i + 1:i + 401] = True
        kept = bytes(x for x, g in zip(b, gone[1:-1]) if not g)
        want[k] = (len(b), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op1_repeats", sf)} == want


def sets_and_components(texts):
    sets = []
    for t in texts:
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")]
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    label = list(range(len(texts)))
    for _ in label:
        for a in range(len(sets)):
            for b in range(a):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return sets, label


def test_jaccard(spark, sf):
    sets, label = sets_and_components(TEXTS)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, "op2_jaccard", sf)} == {
        k: (len(sets[k]), label[k]) for k in range(len(TEXTS))}


def test_quality_rules(spark, sf):
    got = {r.doc_id: r for r in rows(spark, "op4_quality_rules", sf)}
    for k, t in enumerate(TEXTS):
        words, r = WORD.findall(t or ""), got[k]
        windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        often = Counter(windows)
        repeat = len({j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)})
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), repeat)
        assert r.base_failed == (len(words) < 10 or 100 * repeat > 20 * len(words))
        assert not (r.base_failed and r.kept)


def test_mixing(spark, sf):
    got = rows(spark, "op6_mixing", sf)
    size = {k: len(WORD.findall(t or "")) for k, t in enumerate(TEXTS)}
    assert {r.doc_id: r["size"] for r in got} == size
    source = {row[0]: row[3] for row in ROWS}
    total, taken, target = Counter(), Counter(), {}
    for r in got:
        total[source[r.doc_id]] += r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
        assert 0 <= r.taken <= 3 * r["size"]
    weight, left, want = {"a": 1, "b": 2, None: 3}, float(sum(size.values())), {}
    while True:
        free = {s: w for s, w in weight.items() if s not in want}
        over = [s for s in free if left * free[s] / sum(free.values()) > 3 * total[s]]
        if not over:
            want |= {s: left * w / sum(free.values()) for s, w in free.items()}
            break
        for s in over:
            want[s] = 3.0 * total[s]
        left = sum(size.values()) - sum(v for s, v in want.items())
    assert target == pytest.approx(want)
    assert sorted(map(tuple, got)) == sorted(map(tuple, rows(spark, "op6_mixing", sf)))


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return {k: tokenizer.encode(t or "", add_special_tokens=False).ids for k, t in enumerate(TEXTS)}


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_packing(spark, sf, ids):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op8_packing", sf):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for k, found in pieces.items():
        found.sort(key=lambda r: r.piece)
        whole, at = ids[k] + [2], 0
        for n, r in enumerate(found):
            assert (r.piece, r.start, r.ids_crc32) == (n, at, crc(whole[at:at + r.length]))
            at += r.length
        assert at == len(whole) and len(found) == -(-len(whole) // 1024)
        assert all(r.length == 1024 for r in found[1:])
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024


def test_token_files(spark, sf, ids):
    start, want = 0, {}
    for k in sorted(ids):
        want[k] = (start, len(ids[k]) + 1, crc(ids[k] + [0]))
        start += len(ids[k]) + 1
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op9_token_files", sf)} == want


def test_language(spark, sf):
    for r in rows(spark, "op5_language", sf):
        text = TEXTS[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op5_language"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id")
    right = found.selectExpr("avg(int(lang = lang_pred)) AS r").first().r
    assert right >= 0.95


def test_pseudonyms(spark, sf):
    got = {r.doc_id: r for r in rows(spark, "op10_pii", sf)}
    assert all(r.text == TEXTS[k] for k, r in got.items() if not r.n_replaced)
    a, b = (got[TEXTS.index(t)] for t in TEXTS if t and "@" in t)
    assert a.n_replaced >= 1 and b.n_replaced >= 2
    mail = [re.search(r"\S+@[\w.]*\w", r.text)[0] for r in (a, b)]
    assert mail[0] == mail[1] != "anna.bell@example.com"
    assert "4111 1111 1111 1111" not in b.text
    card = re.search(r"card (\d{4} \d{4} \d{4} \d{4}),", b.text)[1].replace(" ", "")
    assert sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(card))) % 10 == 0
    back = pseudonyms.pseudonymised(QUERIES["op10_pii"](spark, sf), PSEUDONYM_KEY, undo=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(TEXTS))


def test_neighbours(spark):
    sf = "/root/testdata/sf0.01"
    found = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    key, x = np.array([r.vec_id for r in found]), np.array([r.embedding for r in found], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    hit = total = 0
    got = defaultdict(list)
    for r in rows(spark, "op7_neighbours", sf):
        got[r.query_id].append(r)
    for q in np.flatnonzero(key % 50 == 0):
        score = x @ x[q]
        score[q] = -2
        best = set(key[np.lexsort((key, -score))[:5]])
        mine = sorted(got[key[q]], key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5]
        for r in mine:
            assert r.score == pytest.approx(score[np.flatnonzero(key == r.vec_id)[0]], abs=1e-12)
        hit, total = hit + len(best & {r.vec_id for r in mine}), total + 5
    assert hit >= 0.9 * total


def test_main_text(spark, tmp_path):
    html = ("<html><head><title>t</title><style>p{}</style></head><body><nav><a href='/'>Home</a></nav><article><h1>On &amp; off</h1>"
            "<p>First  block\n of words.</p><p>Second &eacute;.</p></article><footer>All rights</footer><script>x()</script></body></html>")
    given = [(0, "https://a.example/1", html), (1, "https://a.example/2", None), (2, None, ""), (3, "https://a.example/1", html)]
    spark.createDataFrame(given, "page_id LONG, url STRING, html STRING").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in rows(spark, "op3_html", str(tmp_path))}
    text = "On & off\nFirst block of words.\nSecond é."
    assert got == {0: (given[0][1], text, len(text)), 1: (given[1][1], "", 0), 2: (None, "", 0), 3: (given[0][1], text, len(text))}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert rows(spark, name, empty) == []


def test_pipeline(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "pii", "mixing", "best_fit_packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[1:3]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
    once = corpus_pipeline.near_duplicates(spark, docs, sf)
    _, label = sets_and_components(TEXTS)
    assert sorted(r.doc_id for r in once.collect()) == sorted(set(label))
    final = corpus_pipeline.run(spark, sf)
    assert final.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_words(spark):
    assert spark.range(1).select(mixing.words_in(mixing.F.lit(" a\tb c\x0b d ")).alias("n")).first().n == 3
