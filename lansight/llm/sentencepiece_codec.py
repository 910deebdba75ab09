"""SentencePiece encoding and decoding by shared-prefix Viterbi.

A text gets the model's dummy prefix and white space marks, and falls apart into marked words: no
piece holds a mark after another character, so words are encoded alone.  The distinct words of a
chunk of documents are sorted, which lists their trie depth-first; forward states of a common
prefix are computed once and reused by every word below it.

The forward state of a prefix is its best path: score, last piece, and where that piece starts.
 * unigram models: the best sum of piece scores, as usual;
 * BPE models: a path is admitted only if every neighbouring pair of pieces is what merging by rank
   makes of the two joined.  Such a path is unique for every prefix and equals the library's own
   encoding, so Viterbi needs one state per prefix there too.  (A merge never crosses a final piece
   boundary, so cutting at boundaries leaves each part's merges as they were; and a first crossing
   merge would show in the pair alone.)
Characters without a piece become byte pieces where the model has them, else the unknown piece.

Decoding joins the pieces' bytes, turns marks into spaces and takes the dummy prefix off.

Defined results: null and empty texts have no tokens and decode to an empty text; U+2581 in a text
is the mark itself and decodes to a space, as in the library; every other text decodes to itself;
repeated rows are encoded row by row; an empty table gives an empty result; other columns pass.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lansight.llm.common import Memo, ship

ship(__name__)

MARK = "▁"  # fixed value
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class Pieces:
    """What encoding needs of a model; its size is that of the vocabulary."""

    kind: str  # "unigram" or "bpe"
    scores: dict[str, tuple[int, float]]  # piece -> (id, score), ordinary pieces only
    byte_ids: tuple[int, ...] | None
    unknown: int
    surfaces: dict[int, bytes]
    dummy_prefix: bool = True


def load_pieces(path: str = MODEL_FILE) -> Pieces:
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm = model.normalizer_spec
    if model.trainer_spec.model_type not in (1, 2):
        raise ValueError("only unigram and BPE models have pieces with scores")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only models that leave the text as it is are supported")
    scores, surfaces, data, unknown = {}, {}, {}, 0
    for i, p in enumerate(model.pieces):
        if p.type == 1:
            scores[p.piece] = (i, p.score)
            surfaces[i] = p.piece.replace(MARK, " ").encode()
        elif p.type == 6:
            data[int(p.piece[3:5], 16)] = i
            surfaces[i] = bytes([int(p.piece[3:5], 16)])
        elif p.type == 2:
            unknown = i
            surfaces[i] = model.trainer_spec.unk_surface.encode()
    if any(MARK in p.lstrip(MARK) for p in scores):
        raise ValueError("a piece holds a mark after another character: words can't be encoded alone")
    return Pieces("unigram" if model.trainer_spec.model_type == 1 else "bpe", scores,
                  tuple(data[b] for b in range(256)) if len(data) == 256 else None, unknown, surfaces,
                  norm.add_dummy_prefix)


class Encoder:
    """Viterbi over pieces with forward states shared along the trie of sorted words."""

    def __init__(self, pieces: Pieces, bound: int = 200_000):
        import re

        self.bound = bound  # of the words remembered from chunk to chunk
        self.pieces, self.scores, self.bpe = pieces, pieces.scores, pieces.kind == "bpe"
        self.longest = max(map(len, pieces.scores))
        self.turned = 0  # transitions of the automaton that were added after it was built
        self.floor = min(s for _, s in pieces.scores.values()) - 10.0
        # a line break without a piece parts words as well
        cut = "" if any("\n" in p for p in pieces.scores) else "\n"
        self.words = re.compile(f"{MARK}*[^{MARK}{cut}]+|{MARK}+" + (f"|{cut}" if cut else "")).findall
        self.ids = {p: i for p, (i, _) in pieces.scores.items()}
        self.names = {i: p for p, i in self.ids.items()}
        self.none = max(self.names) + 1  # in place of a last piece: a word's start or an unknown character
        self.pairs = Memo(self._pair_stands, 600_000)
        if self.bpe:
            self._build_automaton()
        self.known: dict[str, bytes] = {}  # a word's ids as little-endian 32-bit numbers

    def _merged(self, text: str) -> list[str]:
        """Merging by rank: the neighbours whose piece has the best score first, the leftmost of ties."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.scores.get(parts[i] + parts[i + 1])
                if found and (best is None or found[1] > best):
                    best, at = found[1], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _pair_stands(self, pair: int) -> bool:
        """Whether merging makes just these two pieces of their joined text (a first piece: just itself)."""
        a, b = divmod(pair, self.none + 1)
        name = self.names[b]
        before = [self.names[a]] if a != self.none else []
        return self._merged("".join(before) + name) == before + [name]

    def _build_automaton(self) -> None:
        """The pieces' own trie with fail links, so that one step a character tells all pieces that end there:
        goto[node] by character, fail[node], ends[node] as (length, id), the longest first."""
        goto, fail, ends, depth = [{}], [0], [()], [0]
        for piece, i in self.ids.items():
            node = 0
            for ch in piece:
                if ch not in goto[node]:
                    goto[node][ch] = len(goto)
                    goto.append({})
                    fail.append(0)
                    ends.append(())
                    depth.append(depth[node] + 1)
                node = goto[node][ch]
            ends[node] = ((len(piece), i),)
        self.goto, self.fail, self.ends = goto, fail, ends
        row = list(goto[0].values())
        while row:
            below = []
            for node in row:
                for ch, child in goto[node].items():
                    back = fail[node]
                    while back and ch not in goto[back]:
                        back = fail[back]
                    fail[child] = goto[back].get(ch, 0)
                    ends[child] += ends[fail[child]]
                    below.append(child)
            row = below

    def _turn(self, node: int, ch: str, bound: int = 300_000) -> int:
        """The node after a character that the trie doesn't go on with, remembered while there is room."""
        back = self.fail[node]
        while back and ch not in self.goto[back]:
            back = self.fail[back]
        back = self.goto[back].get(ch, 0)
        if self.turned < bound:
            self.turned += 1
            self.goto[node][ch] = back
        return back

    def _extend_bpe(self, word: str, shared: int, last: list[int], start_of: list[int], nodes: list[int]) -> None:
        """States of the prefixes longer than ``shared``: (last piece, its start, the automaton's node); one
        path each."""
        goto, ends, pairs, none = self.goto, self.ends, self.pairs, self.none
        scale, node = none + 1, nodes[shared]
        for end in range(shared + 1, len(word) + 1):
            ch = word[end - 1]
            to = goto[node].get(ch)
            node = self._turn(node, ch) if to is None else to
            nodes.append(node)
            for length, piece in ends[node]:
                if pairs[last[end - length] * scale + piece]:
                    last.append(piece)
                    start_of.append(end - length)
                    break
            else:  # a character without a piece merges with nothing
                last.append(none)
                start_of.append(end - 1)

    def _extend_unigram(self, word: str, shared: int, last: list[int], start_of: list[int], best: list[float]) -> None:
        """States of the prefixes longer than ``shared``: (best score, last piece, its start)."""
        for end in range(shared + 1, len(word) + 1):
            score, piece, begin = best[end - 1] + self.floor, self.none, end - 1
            for start in range(max(0, end - self.longest), end):
                found = self.scores.get(word[start:end])
                if found and (best[start] + found[1] > score or piece == self.none):
                    score, piece, begin = best[start] + found[1], found[0], start
            best.append(score)
            last.append(piece)
            start_of.append(begin)

    def _ids(self, word: str, last: list[int], start_of: list[int]) -> bytes:
        out = array("i")
        end, unknown, none = len(word), False, self.none
        while end:
            piece, start = last[end], start_of[end]
            if piece != none:
                out.append(piece)
                unknown = False
            elif self.pieces.byte_ids:
                out.extend(self.pieces.byte_ids[b] for b in reversed(word[start:end].encode()))
            elif not unknown:  # neighbouring unknown characters are one unknown piece
                out.append(self.pieces.unknown)
                unknown = True
            end = start
        out.reverse()
        return out.tobytes()

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not known yet, in trie order."""
        if len(self.known) > self.bound:
            self.known.clear()
        extend = self._extend_bpe if self.bpe else self._extend_unigram
        last, start_of, best, before = [self.none], [0], [0], ""  # best: scores, or the automaton's nodes
        for word in sorted(words.difference(self.known)):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1:], start_of[shared + 1:], best[shared + 1:]
            extend(word, shared, last, start_of, best)
            self.known[word] = self._ids(word, last, start_of)
            before = word

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        marked = text.replace(" ", MARK)
        return self.words(MARK + marked if self.pieces.dummy_prefix else marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian 32-bit numbers."""
        parted = [self.split(t) for t in texts]
        self.learn(set().union(*parted))
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in parted]


def decode_ids(ids: list[int], pieces: Pieces) -> str:
    text = b"".join(map(pieces.surfaces.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if pieces.dummy_prefix and text.startswith(" ") else text


def _chunks(texts: list[str], most: int = 1_000_000):
    """Runs of texts of about ``most`` characters."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield texts[at:i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield texts[at:]


def _codec(shared):
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        pieces = shared.value
        # one encoder a worker process: the broadcast value outlives the task
        encoder = pieces.__dict__.get("encoder") or pieces.__dict__.setdefault("encoder", Encoder(pieces))
        for batch in batches:
            texts = [t or "" for t in batch.column("__text").to_pylist()]
            counts, digests, backs, parts = [], [], [], []
            for chunk in _chunks(texts):
                for text, data in zip(chunk, encoder.encode(chunk)):
                    tokens = np.frombuffer(data, dtype="<i4")
                    counts.append(len(tokens))
                    digests.append(hashlib.sha256(data).hexdigest())
                    backs.append(decode_ids(tokens.tolist(), pieces) == text)
                    parts.append(tokens)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            values = np.concatenate(parts) if parts else np.empty(0, np.int32)
            coded = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(counts, pa.int64()),
                     pa.array(digests, pa.string()), pa.array(backs, pa.bool_())]
            own = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "__text"]
            names = [n for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays(own + coded, names=names + ["token_ids", "n_tokens", "ids_sha256", "round_trip"])
    return run


def encode_documents(docs: DataFrame, model: str = MODEL_FILE, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns with token_ids, n_tokens, ids_sha256 (of little-endian 32-bit ids) and
    round_trip (decoding gave the text back)."""
    from pyspark.sql import types as T

    shared = docs.sparkSession.sparkContext.broadcast(load_pieces(model))  # its size is that of the vocabulary
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in carry] + [
        T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())])
    return docs.select(*[F.col(f"`{c}`") for c in carry], F.col("text").alias("__text")) \
        .mapInArrow(_codec(shared), schema)


def decode_column(tokens: DataFrame, model: str = MODEL_FILE) -> DataFrame:
    """``tokens`` with a column ``text`` decoded from token_ids (null: empty)."""
    shared = tokens.sparkSession.sparkContext.broadcast(load_pieces(model))

    @F.pandas_udf("string")
    def text(ids):
        pieces = shared.value
        return ids.map(lambda x: "" if x is None else decode_ids(list(x), pieces))

    return tokens.withColumn("text", text("token_ids"))


def op8_sentencepiece(docs: DataFrame) -> DataFrame:
    return encode_documents(docs).drop("token_ids")
