import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from offer_engine.llm import alignment
from offer_engine.llm.queries import QUERIES
from tests.llm.edges import edge_rows, table, words

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIRST = Tokenizer.from_file(A)
FIRST.encode_special_tokens = True
SECOND = sentencepiece.SentencePieceProcessor(model_file=B)
LETTERS = alignment.byte_letters()
NAMES = {i: t for t, i in FIRST.get_vocab().items()}
TEXTS = [
    "Hello wörld, it's the dog's  two   spaces\tand\n\n tabs\r\n end ",
    "漢字 ｗｉｄｅ é é 😀👍🏽 ǅ ﻿ ▁ ½",
    " leading", "trailing  ", "   ", " ", "\n", "a\n  b \n c\x0b\x1c d\x85 e\xa0f  g　 h",
    "<|endoftext|> <s> <0x41> </s> <unk> x<|endoftext|>y", "\x00\x01 \x00", "١٢٣ 𝔘𝔫𝔦 👩‍👩‍👧",
    "x" * 3000 + " " + "漢" * 700, "a" + " " * 40 + "b" + " " * 17,
]


def plain(text):
    """Ids with the byte ranges of both tokenizers over a whole text."""
    if not text:
        return None
    data = (" " + text).encode()
    a = FIRST.encode(" " + text, add_special_tokens=False).ids
    b = SECOND.encode(text)
    tokens = (
        [bytes(LETTERS[c] for c in NAMES[i]) for i in a],
        [bytes([int(SECOND.id_to_piece(i)[3:5], 16)]) if SECOND.is_byte(i) else SECOND.id_to_piece(i).replace("▁", " ").encode() for i in b],
    )
    if any(b"".join(t) != data for t in tokens):
        return None
    ranges = []
    for ids, found in zip((a, b), tokens, strict=True):
        ends = np.cumsum([len(t) for t in found]).tolist()
        ranges.append([(i, e - len(t), e) for i, t, e in zip(ids, found, ends, strict=True)])
    return ranges


def brute(texts):
    aligned = [plain(t) for t in texts]
    links, docs = [], Counter()
    for both in aligned:
        found = []
        if both:
            found = [(i, j) for i, s, e in both[0] for j, t, f in both[1] if s < f and t < e]
        links.append(found)
        docs.update(set(found))
    most = defaultdict(int)
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    out = []
    for both, found in zip(aligned, links, strict=True):
        if not both:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = sorted({e for _, _, e in both[0]} & {e for _, _, e in both[1]})
        groups, begin = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, _ in side if begin <= s < cut) for side in both))
            begin = cut
        out.append((
            len(both[0]), len(both[1]), len(groups), len(found), sum(docs[x] == most[x[0]] for x in found),
            sum(docs[x] for x in found), hashlib.sha256(";".join(groups).encode()).hexdigest(),
        ))
    return out


def figures(df):
    return sorted((tuple(r) for r in df.select("doc_id", *alignment.ADDED).collect()), key=repr)


def want(rows):
    found = brute([r[1] for r in rows])
    return sorted(((r[0], *f) for r, f in zip(rows, found, strict=True)), key=repr)


def mixed(seed, n):
    rng = random.Random(seed)
    letters = ["a", "B", "é", "漢", "😀", " ", "  ", "\n", "'s", "1", ".", "ü", "\t", "the ", " of"]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_chunks_give_what_whole_texts_give():
    files = open(A, encoding="utf-8").read(), open(B, "rb").read()
    align, slim = alignment.Aligner(*files), alignment.Aligner(*files, False)
    texts = TEXTS + mixed(1, 500)
    lines = align([t.encode() for t in texts])
    assert slim([t.encode() for t in texts]) == lines
    for text, found in zip(texts, lines, strict=True):
        both = plain(text)
        if both is None:
            assert found is None, text
            continue
        assert "".join(found) == " " + text
        groups = "".join(align.written[c] for c in found)[:-1]
        assert hashlib.sha256(groups.encode()).hexdigest() == brute([text])[0][-1], text
        assert [slim.links[c] for c in found] == [align.links[c] for c in found]


@pytest.mark.parametrize("kept", [1 << 26, 2000])
def test_like_brute_force(spark, kept, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", kept)
    texts = [t for t in TEXTS if len(t) < 500] + mixed(2, 80) + [words(i, 20) for i in range(30)] + ["same text"] * 60
    rows = [(i % 90, t, "en", "a", 0) for i, t in enumerate(texts)]
    got = alignment.align(table(spark, rows).repartition(5), A, B, columns=["doc_id"], slot_bytes=200)
    assert figures(got) == want(rows)


def test_edges_and_clashing_columns(spark):
    rows = [r for r in edge_rows() if r[0] != 8]
    df = table(spark, rows, clashing=True).withColumn("slot", alignment.F.lit("x"))
    got = alignment.align(df, A, B, with_groups=True)
    assert figures(got) == want(rows)
    assert {r["digest"] for r in got.select("digest").collect()} == {"kept digest"}
    for r in got.collect():
        assert (hashlib.sha256(r.groups.encode()).hexdigest() if r.n_a else "") == r.groups_sha256


def test_very_long_texts(spark):
    rows = [(1, words(1, 30_000, 5000), "en", "a", 0), (2, "x" * 20_000, "en", "a", 0)]
    got = {r[0]: r for r in figures(alignment.align(table(spark, rows), A, B))}
    for id_, text, *_ in rows:
        both = plain(text)
        assert got[id_][1:3] == (len(both[0]), len(both[1]))
        cuts = {e for _, _, e in both[0]} & {e for _, _, e in both[1]}
        assert got[id_][3] == len(cuts)


def test_empty(spark):
    assert alignment.align(table(spark, []), A, B).count() == 0


def test_cuts_inside_characters():
    lengths = np.array([1, 1, 1, 1])
    assert alignment.refined(np.array([1, 4, 4, 4]), lengths).tolist() == [1, 2, 3, 4]
    assert alignment.refined(np.array([3, 7]), np.array([3, 4])).tolist() == [3, 7]


def test_query_like_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: r for r in figures(QUERIES["op13_alignment"](spark, sf))}
    # Links by two pointers, as all pairs of a long text's tokens are too many.
    align = alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    held, docs = {}, Counter()
    for id_, text in rows:
        both, pairs = plain(text), []
        if both:
            j = 0
            for i, s, e in both[0]:
                while both[1][j][2] <= s:
                    j += 1
                k = j
                while k < len(both[1]) and both[1][k][1] < e:
                    pairs.append((i, both[1][k][0]))
                    k += 1
        held[id_] = pairs
        docs.update(set(pairs))
    most = defaultdict(int)
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    for id_, text in rows:
        pairs, found = held[id_], got[id_]
        assert found[4:7] == (len(pairs), sum(docs[p] == most[p[0]] for p in pairs), sum(docs[p] for p in pairs))
        assert bool(align([(text or "").encode()])[0]) == bool(pairs) == bool(found[7])


def test_signs_behind_words_are_chunks_of_their_own():
    align = alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    texts = ["word, word. Word! word?! word", "a, ", "é.  b", "x.y, z_. 3. q,\n r;", "a,", "w... w.,; w:", "end. ", "it's, (b). ², ½. ª.", "n\u0303, e.\u0301 ."]
    lines = align([t.encode() for t in texts])
    assert lines[0] == [" word", ",", " word", ".", " Word", "!", " word", "?!", " word"]
    for text, found in zip(texts, lines, strict=True):
        if (want := brute([text])[0])[0]:
            assert "".join(found) == " " + text
            assert hashlib.sha256("".join(align.written[c] for c in found)[:-1].encode()).hexdigest() == want[-1], text
            assert sum(len(align.links[c]) // 8 for c in found) == want[3]
        else:
            assert found is None


def test_signs_stay_with_words_where_a_piece_joins_them(monkeypatch):
    align = alignment.Aligner(open(A, encoding="utf-8").read(), open(B, "rb").read())
    align.parted = False
    assert align([b"word, word."]) == [[" word,", " word."]]
