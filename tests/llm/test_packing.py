import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from offer_engine.llm import packing
from tests.llm.edges import edge_rows, table, words

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(VOCABULARY)


def tokens(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [packing.END]


def check(rows, pieces, window):
    want, got, lines = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in rows:
        want[r[0]].append(tokens(r[1]))
    for p in pieces:
        ids = list(np.frombuffer(p.ids, "<u4"))
        assert len(ids) == p.length > 0
        got[p.doc_id].append((p.start, p.doc_tokens, ids))
        lines[p.sequence_id].append((p.offset, p.length))
    for line in lines.values():
        at = 0
        for offset, n in sorted(line):
            assert offset == at
            at += n
        assert at <= window
    for doc, texts in want.items():
        assert sorted(x for _, _, ids in got[doc] for x in ids) == sorted(x for t in texts for x in t)
        if len(texts) == 1:
            assert [x for _, _, ids in sorted(got[doc]) for x in ids] == texts[0]
            assert {n for _, n, _ in got[doc]} == {len(texts[0])}
    return lines


def test_each_token_lies_in_one_piece_and_windows_are_full(spark):
    rows = [(i, words(i % 50, 3 + 17 * (i % 40), 300), "en", "a", 0) for i in range(300)]
    pieces = packing.pack(table(spark, rows), VOCABULARY, window=512, shard_tokens=1 << 15).collect()
    lines = check(rows, pieces, 512)
    padding = sum(512 - sum(n for _, n in line) for line in lines.values())
    assert padding < 0.03 * sum(p.length for p in pieces)


def test_edges_and_clashing_columns(spark):
    pieces = packing.pack(table(spark, edge_rows(), clashing=True), VOCABULARY).collect()
    check(edge_rows(), pieces, packing.WINDOW)


def test_empty(spark):
    assert packing.pack(table(spark, []), VOCABULARY).count() == 0


def test_checksum(spark):
    df = packing.pack(table(spark, [(1, "one two", "en", "a", 0)]), VOCABULARY)
    assert packing.with_checksum(df).first().ids_crc32 == packing.crc32(tokens("one two"))
    assert packing.crc32([1, 2]) == zlib.crc32(b"\x01\0\0\0\x02\0\0\0")


def test_encoder_equals_the_library():
    encode = packing.encoder(open(VOCABULARY, encoding="utf-8").read(), "H")
    texts = [
        "It's the dog's, we'll say: 'twas they'd!? a_b 3.14 x2y",
        "Ångström ÉCOLE straße ǅ İstanbul ΣΑΣ Ꮳ 漢字 ｗｉｄｅ é é",
        "tab\tline\nfeed\x0b\x0c\r\x1c\x1d\x1e\x1f nb\xa0sp em　cjk​zero\x85next",
        "<|endoftext|> <|startoftext|> 😀👍🏽 \x00\x01 ½ ² ٣",
        "x <|endoftext|> y a<|endoftext|>b<|startoftext|><|startoftext|>É <|endof text|> <|ENDOFTEXT|>",
        "",
        words(3, 500, 10**6),
    ]
    for t in texts * 2:
        assert list(np.frombuffer(encode(t), "<u2")) == LIBRARY.encode(t, add_special_tokens=False).ids


def test_retrieval_prefers_like_documents():
    topics = [np.arange(1000 * k, 1000 * k + 100) for k in range(5)]
    docs = [t[at : at + 60] for at in (0, 20, 40) for t in topics]
    lines = packing.windows([d.astype("<u2") for d in docs], 180)
    assert [{d % 5 for d, _, _ in line} for line in lines] == [{k} for k in range(5)]


def test_large_keys_are_dealt_to_shards_of_bounded_size():
    plan = packing.shards([(1, 10), (2, 95), (3, 30), (4, 1000), (5, 5)], 100)
    assert plan == [(1, 0, 1), (2, 1, 1), (3, 2, 1), (4, 3, 10), (5, 13, 1)]


def test_latin_texts_are_cut_like_the_library():
    encode = packing.encoder(open(VOCABULARY, encoding="utf-8").read(), "H")
    signs = ["a.. b", "a., b. c", "x_. y_ .", "3. 4, 5!", "l'été, ÉTÉ: Straße? oui ! it's. IT'S, ", "e.g. i.e., \"q.\" (w). ", "Ⱥ. Ⱦ, ª! µ? ", "a .b . c", ". , ; a.\tb.\nc."]
    near = ["a. <|ENDOFTEXT|> B, c", "A. <|endoftext|> B, C.", "\x1c. a\x1d, B. c", "İ. É, x", "n\u0303. A, b"]
    for t in signs + near + [s.upper() for s in signs]:
        assert list(np.frombuffer(encode(t), "<u2")) == LIBRARY.encode(t, add_special_tokens=False).ids, t


def test_keys_of_many_documents():
    tails = [np.array(x, "<u2") for x in ([2], [5, 2], [7, 7, 2], list(range(9, 4000)), [5, 2])]
    alone = [packing.lexical_keys([t])[0] for t in tails]
    assert packing.lexical_keys(tails) == alone and alone[1] == alone[4] and packing.lexical_keys([]) == []
    for t, key in zip(tails, alone, strict=True):
        pairs = t[:-1].astype(np.uint64) << np.uint64(32) | t[1:]
        least = [packing.scrambled(x).min() for x in (t, pairs if len(pairs) else t)]
        top, low = (int(packing.scrambled(np.array([x]))[0]) >> 40 & 127 for x in least)
        assert key == top << 7 | low
