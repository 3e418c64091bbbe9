"""Fill-in-the-middle, SentencePiece and vector codes against brute-force statements of their
rules and against the public library, with nulls, empty and long inputs, ties, repeated rows,
empty tables and clashing columns."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from parity import compare, duck
from pyspark.sql import functions as F

from cohortline.llm import fill_middle, queries, sentence_pieces, vector_codes
from cohortline.llm.common import saved

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = "doc_id long, text string, n string, piece_ids string, source string"


def text_rows(texts, ids=None):
    return [(i, t, "clash", "clash", None) for i, t in zip(ids or range(len(texts)), texts)]


@pytest.mark.parametrize("name", ["op11_fill_middle", "op13_vector_codes"])
def test_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    out = compare(spark, duck(sf), name, queries.QUERIES[name], queries.ORACLE[name], sf)
    assert out["ok"], out


# ---- 11 fill in the middle

def cut(doc_id, text):
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle(spark):
    rng = random.Random(3)
    alphabet = ["word", "A", " ", "\n", "$1", "\\", "<", "P>", "<S", ">", "é", "😀", " ", "\r", "0", "\x00", "<M>"]
    texts = [None, "", "abc", "   ", "<P>", "x" * 300_000, "ab, " * 200_000]
    texts += ["".join(rng.choice(alphabet[:-1] if k % 9 else alphabet) for _ in range(rng.randint(1, 40))) for k in range(300)]
    rows = text_rows(texts) + text_rows([texts[9], texts[9], "null id"], [9, 9, None])
    docs = spark.createDataFrame(rows, TEXTS)
    out = fill_middle.transform(docs).withColumn("again", fill_middle.restore(F.col("output"), F.col("form")))
    got = out.collect()
    assert len(got) == len(rows) and {"source", "piece_ids"} < set(out.columns)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    for r in got:
        text = r["text"] or ""
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == cut(r["doc_id"], text)
        assert r["again"] == text
    assert fill_middle.transform(docs.limit(0)).count() == 0


def test_fill_middle_sentinels(spark):
    plan = fill_middle.Plan(prefix="$1\\a", suffix="{x}", middle="|", rate=100)
    docs = spark.createDataFrame(text_rows(["some text, more of it $ \\ {", "{x}"]), TEXTS)
    for r in fill_middle.transform(docs, plan).withColumn("again", fill_middle.restore(F.col("output"), F.col("form"), plan)).collect():
        assert r["again"] == r["text"] and (r["form"] == "plain") == (r["text"] == "{x}")
    for marks in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "x"), ("aba", "x", "y"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            fill_middle.Plan(prefix=marks[0], suffix=marks[1], middle=marks[2])


# ---- 12 sentence pieces

PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "▁", "é", "ñ", "中", "日本", "😀", "\x00", "　", "1", "23", "<s>", "<0x0A>",
         "�", "\t", "Ω", "ｆ", "<unk>", " hello", " world", ",", ".", "'s", "—", "€%%%", "▁▁", "½", "_x"]


@pytest.fixture(scope="module")
def coder():
    with open(MODEL, "rb") as f:
        return sentence_pieces.Coder(sentence_pieces.Model.parse(f.read()))


def random_texts(count, parts=PARTS, seed=5, most=25):
    rng = random.Random(seed)
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, most))) for _ in range(count)]


def test_pieces_equal_the_library(coder):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = random_texts(4000) + ["x" * 5000, "ab" * 3000 + " " * 300, " ", "\n\n", "▁"]
    for text, (ids, ends, start) in zip(texts, coder.encode(texts)):
        expected = library.encode(text, return_type="proto")
        assert ids.tolist() == [p.id for p in expected.pieces], text
        assert ends.tolist() == [p.end for p in expected.pieces] and start == 0
        assert coder.decode(ids.tolist()) == library.decode(ids.tolist())
    rng = random.Random(6)
    for _ in range(4000):
        ids = [rng.randrange(3, 260) if rng.random() < .6 else rng.randrange(32000) for _ in range(rng.randint(0, 8))]
        assert coder.decode(ids) == library.decode(ids), ids


def test_words_change_nothing(coder):
    """Encoding by words in batches equals merging the whole normalised text at once."""
    texts = random_texts(500, seed=7)
    for text, (ids, ends, _) in zip(texts, coder.encode(texts)):
        packed, start = coder._whole(text)
        whole = coder._spans(packed, start)
        assert ids.tolist() == whole[0].tolist() and ends.tolist() == whole[1].tolist()


def test_ties_go_left():
    """Pieces of one score: the leftmost pair first, by matrix or by queue."""
    model = sentence_pieces.Model(
        pieces=["<unk>", "a", "b", "▁", "aa", "ab", "ba", "bb"], scores=[0, -9, -9, -9, -1, -1, -1, -2], types=[2] + [1] * 7,
        extra_blanks_removed=False, model_type=2)
    coder = sentence_pieces.Coder(model)
    for text in random_texts(300, ["a", "b", " "], most=12):
        symbols = list("▁" + text.replace(" ", "▁")) if text else []
        while True:
            pairs = [(-model.scores[model.pieces.index(a + b)], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
                     if a + b in model.pieces]
            if not pairs:
                break
            i = min(pairs)[1]
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
        assert [model.pieces[i] for i in coder.encode([text])[0][0]] == symbols


def test_unknown_without_bytes_is_one_piece():
    model = sentence_pieces.Model(pieces=["<unk>", "a", "▁"], scores=[0, -1, -2], types=[2, 1, 1],
                                  extra_blanks_removed=False, model_type=2)
    ids, ends, _ = sentence_pieces.Coder(model).encode(["aéüa"])[0]
    assert ids.tolist() == [2, 1, 0, 1] and ends.tolist() == [0, 1, 5, 6]
    with pytest.raises(ValueError):
        sentence_pieces.Coder(sentence_pieces.Model(pieces=["<unk>"], scores=[0], types=[2], model_type=1))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf", "nmt_nfkc_cf"])
def test_character_map_equals_the_library(rule):
    """Longest-prefix replacement and its alignment, under the library's own compiled maps."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    normalize = sentence_pieces.Normalizer(sentence_pieces.Model.parse(library.serialized_model_proto()))
    for text in random_texts(1500, [*PARTS, "①", "ﬁ", "ｶﾞ", "é", "​", "ſ", "İ", "㍿", "\xa0", "ß", "Å"], most=15):
        expected, places = library.normalize(text, with_offsets=True)
        assert normalize(text) == (expected, [len(text[:p].encode()) for p in places])


def test_pieces_in_spark(spark, coder):
    texts = [None, "", " ", "one two", "naïve 中 😀", "one two", "long words " * 60_000, "y" * 70_000]
    docs = spark.createDataFrame(text_rows(texts), TEXTS)
    out = sentence_pieces.encode(docs, MODEL, decoded=True)
    out = out.withColumn("spans", sentence_pieces.spans(F.col("piece_ends"), F.col("text_start")))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for r in out.collect():
        data = (r["text"] or "").encode()
        assert r["piece_ids"] == library.encode(r["text"] or "") and r["n_tokens"] == len(r["piece_ids"])
        assert r["decoded"] == (r["text"] or "")
        assert b"".join(data[s["start"]:s["end"]] for s in r["spans"]) == data
    again = sentence_pieces.decode(out.drop("decoded"), MODEL).select("text", "decoded").collect()
    assert all(r["decoded"] == (r["text"] or "") for r in again)
    assert sentence_pieces.encode(docs.limit(0), MODEL).count() == 0
    assert sentence_pieces.decode(spark.createDataFrame([(None,)], "piece_ids array<int>"), MODEL).first()["decoded"] == ""


# ---- 13 vector codes

def lloyd(rows, entries=256, rounds=4, parts=4):
    """The rule, entry by entry: (ids, codes, errors, codebooks)."""
    kept = sorted((i, v) for i, v in rows)
    x = np.floor(np.array([v for _, v in kept], np.float64) * 1024).astype(np.int64)
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % parts))).reshape(len(x), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]
    nearest = lambda p: ((x[:, p, None] - books[p][None]) ** 2).sum(-1)
    for _ in range(rounds):
        chosen = [nearest(p).argmin(1) for p in range(parts)]
        for p in range(parts):
            for e in set(chosen[p].tolist()):
                books[p][e] = x[chosen[p] == e, p].sum(0) // (chosen[p] == e).sum()
    squares = [nearest(p) for p in range(parts)]
    codes = [bytes(c) for c in np.stack([s.argmin(1) for s in squares], 1).astype(np.uint8)]
    return [i for i, _ in kept], codes, sum(s.min(1) for s in squares), books


def check_codes(spark, rows, odd=()):
    frame = spark.createDataFrame([(i, v, None if i is None or i % 3 else 7, "x") for i, v in [*rows, *odd]],
                                  "vec_id long, embedding array<double>, label int, code string").repartition(3)
    books = vector_codes.fit(frame)
    got = sorted(((r["vec_id"], bytes(r["code"]), r["error"]) for r in vector_codes.encode(frame, books).collect()), key=str)
    ids, codes, errors, entries = lloyd(rows)
    assert got == sorted(zip(ids, codes, errors.tolist()), key=str)
    assert np.array_equal(books.entries, np.stack(entries))
    return frame, books


def test_codes(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(900), rng.normal(0, .2, (900, 8)).round(2))]
    nan, inf = float("nan"), float("inf")
    odd = [(-1, None), (-2, []), (-3, [0.0] * 7 + [None]), (-4, [nan] * 8), (-5, [inf] + [0.0] * 7), (5000, [1.0] * 4)]
    frame, books = check_codes(spark, rows, odd)
    coded = saved(vector_codes.encode(frame, books))
    decoded = vector_codes.decode(coded, books).collect()
    for r in decoded:
        x = np.floor(np.array(r["embedding"]) * 1024)
        assert ((x - np.array(r["decoded"]) * 1024) ** 2).sum() == r["error"]
    sums = {}
    for r in coded.collect():
        sums[r["label"]] = sums.get(r["label"], 0) + r["error"]
    out = vector_codes.with_sums(coded, "label", "error", "label_error").collect()
    assert len(out) == 900 and all(r["label_error"] == sums[r["label"]] for r in out)


def test_codes_of_few_equal_large_and_odd_vectors(spark):
    check_codes(spark, [(i, [0.5, -0.25, 0.125]) for i in range(5)])                       # ties, 3 is no multiple of 4
    check_codes(spark, [(i, [float(i % 7), -float(i % 5), 0.0, 1e3]) for i in range(400)])  # repeated vectors
    check_codes(spark, [(i, [16000.0 - i, i * 3.3, -16000.0, i * i / 7] * 8) for i in range(300)])    # sums beyond 2^53
    many = [(3, [1e300, -1e300, 0.0, 0.0]), (3, [1e300, -1e300, 0.0, 0.0]), (None, [1.0] * 4)]
    frame = spark.createDataFrame(many, "vec_id long, embedding array<double>")
    books = vector_codes.fit(frame)
    assert books.entries[0, 0, 0] == vector_codes.LIMIT and vector_codes.encode(frame, books).count() == 3
    empty = frame.limit(0)
    assert vector_codes.fit(empty) is None and vector_codes.encode(empty, None).count() == 0


def test_cold_and_hot_sums(spark):
    frame = saved(spark.createDataFrame([(None if i % 3 == 0 else i, i) for i in range(6000)], "k long, v long"))
    got = vector_codes.with_sums(frame, "k", "v", "total").collect()
    nulls = sum(range(0, 6000, 3))
    assert len(got) == 6000 and all(r["total"] == (nulls if r["k"] is None else r["v"]) for r in got)


def test_slices_search_is_exact():
    rng = np.random.default_rng(2)
    for entries in (1, 2, 63, 64, 65, 256):
        book = rng.integers(-40, 40, (entries, 3))
        points = rng.integers(-90, 90, (500, 3))
        squares = ((points[:, None] - book[None]) ** 2).sum(-1)
        for radius in (0, 1, 7, 10_000):
            index, error = vector_codes.Slices(book).nearest(points, radius)
            assert np.array_equal(index, squares.argmin(1)) and np.array_equal(error, squares.min(1))
        # the masks name exactly the entries in the cube
        masks = np.unpackbits(vector_codes.Slices(book).candidates(points, np.full(500, 9)).view(np.uint8), axis=1,
                              bitorder="little", count=entries).astype(bool)
        assert np.array_equal(masks, (np.abs(points[:, None] - book[None]) <= 9).all(-1))
