"""SentencePiece: the library's own ids, exact round trips, and brute-force Viterbi for unigram models."""

from __future__ import annotations

import itertools
import random
from array import array

from llm_rows import EDGE, docs, prose, row  # noqa: F401

from lansight.llm.sentencepiece_codec import (MARK, MODEL_FILE, Encoder, Pieces, decode_column, decode_ids,
                                              encode_documents, load_pieces, op8_sentencepiece)


def texts():
    rnd = random.Random(4)
    signs = list("ab \n\t日é😀 <s>ﬁ12the\x00\x85  ") + ["tion", "ing ", "▁"]
    return ["".join(rnd.choice(signs) for _ in range(rnd.randrange(80))) for _ in range(500)] + \
        ["", " ", " " * 40, "\n\n  \n", "a" * 400, "0123456789" * 20, "日本語テキスト" * 9, prose(1, 600)]


def test_ids_equal_the_library_and_come_back():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    pieces = load_pieces()
    encoder = Encoder(pieces, bound=50)  # forgetting words changes nothing
    every = texts()
    for at in range(0, len(every), 60):
        part = every[at:at + 60]
        for text, data in zip(part, encoder.encode(part)):
            ids = list(array("i", data))
            assert ids == library.encode(text)
            assert decode_ids(ids, pieces) == text.replace(MARK, " ")


def test_unigram_paths_are_the_best_of_all_segmentations():
    rnd = random.Random(6)
    names = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 4))) for _ in range(25)} | {"a", "b", "c", MARK + "a", MARK})
    scores = {p: (i + 3, -rnd.random() * 6 - 0.1) for i, p in enumerate(names)}
    pieces = Pieces("unigram", scores, None, 0, {})
    encoder = Encoder(pieces)
    best_of = {}
    for word in {"".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 9))) for _ in range(60)}:
        marked = MARK + word
        best = None
        for cuts in itertools.product((0, 1), repeat=len(marked) - 1):
            ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(marked)]
            parts = [marked[a:b] for a, b in zip([0, *ends], ends)]
            if all(p in scores for p in parts):
                best = max(best or (-1e9, None), (sum(scores[p][1] for p in parts), parts))
        best_of[word] = best
    got = dict(zip(best_of, encoder.encode(list(best_of))))
    score = {i: s for i, s in scores.values()}
    name = {i: p for p, (i, _) in scores.items()}
    for word, (best, _) in best_of.items():
        ids = list(array("i", got[word]))
        assert "".join(name[i] for i in ids) == MARK + word and abs(sum(score[i] for i in ids) - best) < 1e-9


def test_unknown_characters_are_one_unknown_piece_without_byte_pieces():
    encoder = Encoder(Pieces("unigram", {MARK: (3, -1.0), "a": (4, -1.0)}, None, 0, {}))
    assert list(array("i", encoder.encode(["a\u00e9\u00e9a"])[0])) == [3, 4, 0, 4]


def test_documents_round_trip(docs):
    rows = [row(i, t) for i, t in enumerate(texts())] + EDGE
    got = op8_sentencepiece(docs(rows, clash=True)).collect()
    assert len(got) == len(rows)
    marked = {r[0] for r in rows if MARK in (r[1] or "")}
    assert all(g.round_trip or g.doc_id in marked for g in got)
    assert all(g.n_tokens == 0 for g in got if g.doc_id == 1 and g.round_trip and not g.n_tokens)


def test_decoded_column(docs):
    rows = [row(1, "Hello  world\n"), row(2, None), row(3, "é 😀")]
    out = decode_column(encode_documents(docs(rows), carry=("doc_id", "lang"))).collect()
    assert {r.doc_id: r.text for r in out} == {1: "Hello  world\n", 2: "", 3: "é 😀"}
    assert op8_sentencepiece(docs([])).collect() == []
