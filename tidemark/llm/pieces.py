"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives one Viterbi pass."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark import SparkFiles
from pyspark.sql import DataFrame

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
MEMO = 200_000  # chunks whose ids a worker remembers; then it starts anew


class Words(dict):
    """Ids of words after a space, as bytes, made when first asked for."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(SPACE + word).tobytes()
        if len(word) < 64:
            if len(self) >= MEMO:
                self.clear()
            self[word] = ids
        return ids


class Pieces:
    """A piece vocabulary with byte fallback.

    A space becomes U+2581, and one stands before the text. Characters without a
    piece, and U+2581 itself, go as their bytes' pieces, so that decoding gives the text back.
    """

    def __init__(self, model: bytes) -> None:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.texts = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.byte_ids = [0] * 256
        self.bytes_of: dict[int, int] = {}
        scores = {}
        for i, piece in enumerate(self.texts):
            if sp.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.bytes_of[i] = int(piece[1:-1], 16)
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                scores[piece] = (sp.get_score(i), i)
        self.lost = min((s for s, _ in scores.values()), default=0.0) - 10.0
        self.automaton = ahocorasick.Automaton()
        for piece, (score, i) in scores.items():
            self.automaton.add_word(piece, (len(piece), score, i))
        self.automaton.make_automaton()
        # If no piece holds a space after another sign, the best path breaks before every run of spaces.
        self.breaks = not any(SPACE in p.lstrip(SPACE) for p in scores)
        self.plain = [p.replace(SPACE, " ") for p in self.texts]
        self.memo: dict[str, array] = {}
        self.words = Words(self.viterbi)

    def viterbi(self, chunk: str) -> array:
        """Ids of the segmentation of largest total score; at ties the longer last piece wins.

        The automaton reports, at each end, all pieces that end there (its output
        links); each relaxes the best score of that position.
        """
        n, lost = len(chunk), self.lost
        best, width, piece = [0.0] * (n + 1), [1] * (n + 1), [-1] * (n + 1)
        done = 0
        for end, (size, score, i) in self.automaton.iter(chunk):
            at = end + 1
            if at != done:  # the first piece that ends here
                while done < at:  # positions no piece reaches, and the one without a piece to this
                    best[done + 1] = best[done] + lost
                    done += 1
            total = best[at - size] + score
            if total > best[at] or (total == best[at] and size > width[at]):
                best[at], width[at], piece[at] = total, size, i
        ids, at = [], n
        while at:
            if piece[at] >= 0:
                ids.append(piece[at])
            else:
                ids += [self.byte_ids[b] for b in reversed(chunk[at - 1].encode())]
            at -= width[at]
        ids.reverse()
        return array("i", ids)

    def encode(self, text: str | None) -> array:
        """Ids of the whole text; null and empty texts have none."""
        ids = array("i")
        if not text:
            return ids
        words = text.split(" ")
        if self.breaks and all(words) and SPACE not in text and "\0" not in text:  # each word is a chunk after one space
            ids.frombytes(b"".join(map(self.words.__getitem__, words)))
            return ids
        if SPACE in text or "\0" in text:  # signs that would not come back: bytes between encoded parts
            parts, run = [], []
            for c in text:
                if c in (SPACE, "\0"):
                    parts += ["".join(run), c]
                    run = []
                else:
                    run.append(c)
            parts.append("".join(run))
        else:
            parts = [text]
        first = True
        for part in parts:
            if part in (SPACE, "\0"):
                if first:
                    ids.extend(self._chunk(SPACE))
                ids.extend(self.byte_ids[b] for b in part.encode())
            elif part:
                marked = (SPACE if first else "") + part.replace(" ", SPACE)
                for chunk in self._chunks(marked):
                    ids.extend(self._chunk(chunk))
            else:
                continue
            first = False
        return ids

    def _chunks(self, marked: str) -> Iterator[str]:
        if not self.breaks:
            yield marked
            return
        held = ""
        words = marked.split(SPACE)
        if words[0]:
            yield words[0]
        for word in words[1:]:
            held += SPACE
            if word:
                yield held + word
                held = ""
        if held:
            yield held

    def _chunk(self, chunk: str) -> array:
        ids = self.memo.get(chunk)
        if ids is None:
            ids = self.viterbi(chunk)
            if len(chunk) <= 64:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[chunk] = ids
        return ids

    def decode(self, ids) -> str:
        """The text of the ids: byte runs are read as UTF-8, the space put before the text is taken off."""
        out, run = [], bytearray()
        for i in ids:
            b = self.bytes_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(self.plain[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)[1:]


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    with open(path, "rb") as f:
        return Pieces(f.read())


def shipped(spark, model: str) -> str:
    """The model's name among the files that Spark sends to every executor."""
    spark.sparkContext.addFile(model)
    return os.path.basename(model)


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, n_tokens, ids, exact``: the ids of each whole text, and whether they decode to it.

    Null and empty texts have no ids. Equal rows come out equal; other columns are left out.
    """
    name = shipped(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(SparkFiles.get(name))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                flat, ends, exact = array("i"), [0], []
                for text in part.column(1).to_pylist():
                    ids = vocabulary.encode(text)
                    exact.append(vocabulary.decode(ids) == (text or ""))
                    flat.extend(ids)
                    ends.append(len(flat))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(memoryview(flat), pa.int32()))
                counts = pa.array([b - a for a, b in zip(ends, ends[1:])], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), counts, lists, pa.array(exact)],
                                                 ["doc_id", "n_tokens", "ids", "exact"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids array<int>, exact boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``; null ids give a null text."""
    name = shipped(encoded.sparkSession, model)

    def run(batches):
        vocabulary = pieces(SparkFiles.get(name))
        for batch in batches:
            texts = [None if ids is None else vocabulary.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
