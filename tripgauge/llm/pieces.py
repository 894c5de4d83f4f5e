"""N-best SentencePiece segmentation, encoding and decoding.

The vocabulary is a SentencePiece model's; the lattice of a text has an edge for every piece that
occurs in it, and for every character that is no piece, one edge per UTF-8 byte. A merge model's
scores are ranks, which cannot be added, so a piece of rank r weighs -log(r + 10), as word
frequencies do, in whole millionths so that sums are exact.

Forward, Viterbi finds the best score from the start to each place. Backward, A* search from the end
extends paths by their score so far plus that Viterbi score, which is exactly what the rest can
still add, so paths come out in order, best first, and no path worse than the last is ever opened.

No piece joins a space to what stands before it, and some characters are in no longer piece, so a
text's lattice falls apart into chunks, words mostly. The search runs per distinct chunk and its
answers are kept (at most `room` of them); the best whole paths then follow from the chunks'
differences to their best.

Defined results: a null or empty text has one path without pieces, score 0; a literal U+2581 is
written as bytes, so every path of every text decodes to the text; rows are kept one by one; an
empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import itertools
import re
import zlib
from bisect import insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripgauge.llm.common import kept_by_worker

SPACE = "▁"
UNIT = 1_000_000
MARK, NEVER = 1 << 31, (1 << 31) - 1


class Vocabulary(dict):
    """Pieces with scores from a SentencePiece model file; a space in a piece is a plain space here.

    As a dict it keeps the answers for the chunks met last.
    """

    def __init__(self, path: str, n: int = 4, room: int = 600_000):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text: list[bytes] = []
        self.id_of: dict[str, int] = {}
        self.score: dict[str, int] = {}
        self.byte_ids = [0] * 256
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_ids[value] = i
                self.text.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                plain = piece.replace(SPACE, " ")
                self.text.append(plain.encode())
                self.id_of[plain] = i
                self.score[plain] = -round(UNIT * float(np.log(10 - model.get_score(i))))
        self.byte_score = min(self.score.values(), default=0) - 5 * UNIT
        self.pieces = ahocorasick.Automaton()
        for piece, score in self.score.items():
            self.pieces.add_word(piece, (len(piece), score))
        self.pieces.make_automaton()
        # Where no piece holds two neighbouring characters, every path has a cut. The three patterns
        # take that as far as the vocabulary allows: cuts after letters, cuts before spaces, none.
        pairs = {pair for piece in self.score for pair in zip(piece, piece[1:])}
        inner = {c for pair in pairs for c in pair} - {" "}
        name = lambda chars: "".join(map(re.escape, sorted(chars)))
        letters, others = name({c for c in inner if c.isalpha()}), name({c for c in inner if not c.isalpha()})
        if any(b == " " != a for a, b in pairs) or not letters or not others:
            self.chunks = re.compile(r".+", re.S).findall
        elif any(a.isalpha() and not b.isalpha() for a, b in pairs):
            self.chunks = re.compile(rf" *[{letters}{others}]+| +|[^ {letters}{others}]").findall
        else:
            self.chunks = re.compile(rf" *[{others}]*[{letters}]+| *[{others}]+| +|[^ {letters}{others}]").findall
        self.score_of = np.array([0] * len(self.text), dtype=np.int64)
        self.score_of[self.byte_ids] = self.byte_score
        self.score_of[list(self.id_of.values())] = list(self.score.values())
        self.id_bytes = [i.to_bytes(4, "little") for i in range(len(self.text))]
        self.n, self.room = n, room

    def search(self, chunk: str, n: int) -> list[tuple[int, tuple]]:
        """The n best paths through one chunk, best first: score, and the ends of the pieces as nested pairs."""
        size = len(chunk)
        into: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        for last, (length, score) in self.pieces.iter(chunk):  # every piece at every place, in one pass
            into[last + 1].append((last + 1 - length, score))
        best = [0]
        for end in range(1, size + 1):
            edges, top = into[end], None
            if chunk[end - 1] not in self.score:  # no piece: one edge of bytes
                edges.append((end - 1, self.byte_score * len(chunk[end - 1].encode())))
            for start, score in edges:
                reach = best[start] + score
                if top is None or reach > top:
                    top = reach
            best.append(top)
        # An open path's total is reached by some whole path, so none but the best of the paths still
        # wanted need stay open. Of equal totals the one opened last goes on first.
        found, open_paths, turn, wanted = [], [(best[-1], 0, size, 0, ())], 0, n
        while open_paths and wanted:
            total, _, place, gone, cuts = open_paths.pop()
            if not place:
                found.append((total, cuts))
                wanted -= 1
                continue
            for start, score in into[place]:
                reach = gone + score + best[start]
                if len(open_paths) >= wanted:
                    if reach <= open_paths[0][0]:
                        continue
                    del open_paths[0]
                turn += 1
                insort(open_paths, (reach, turn, start, gone + score, (place, cuts)))
        return found

    def _ids(self, chunk: str, cuts: tuple) -> bytes:
        out, start = [], 0
        while cuts:
            end, cuts = cuts
            piece = chunk[start:end]
            if piece in self.score:
                out.append(self.id_bytes[self.id_of[piece]])
            else:
                out += [self.id_bytes[self.byte_ids[b]] for b in piece.encode()]
            start = end
        return b"".join(out)

    def __missing__(self, chunk: str) -> bytes:
        """Loss of the second best path, marked by the top bit, and the best ids; other paths are searched where needed.

        One piece of bytes per chunk: a text's chunks are joined and taken apart by numpy.
        """
        paths = self.search(chunk, min(2, self.n))
        loss = min(paths[0][0] - paths[1][0], NEVER) if len(paths) > 1 else NEVER
        found = (MARK | loss).to_bytes(4, "little") + self._ids(chunk, paths[0][1])
        if len(chunk) <= 48:
            if len(self) >= self.room:
                self.clear()
            self[chunk] = found
        return found

    def encode(self, text: str | None) -> list[tuple[int, bytes]]:
        """The n best segmentations (score, ids) of a whole text, best first; fewer if there are fewer.

        ids are little-endian unsigned 32-bit numbers.
        """
        return [(score, ids) for score, ids, _ in self.paths(text)]

    def paths(self, text: str | None) -> list[tuple[int, bytes, list[tuple[str, bytes]]]]:
        """As encode, with the chunks (text, ids) in which a path differs from the best one."""
        if not text:
            return [(0, b"", [])]
        chunks = self.chunks(" " + text)
        joined = np.frombuffer(b"".join([self[c] for c in chunks]), dtype="<u4")
        marked = joined >= MARK
        ids, begins = joined[~marked], np.flatnonzero(marked)
        begins = begins - np.arange(len(begins))  # where each chunk's ids begin
        total = int(self.score_of[ids].sum())
        out = [(total, ids.tobytes(), [])]
        if self.n > 1:
            # n - 1 changes at most, and only at the n - 1 places where a first change costs least
            losses, wanted = joined[marked] & (MARK - 1), self.n - 1
            limit = np.partition(losses, wanted - 1)[wanted - 1] if len(losses) > wanted else NEVER
            near = np.flatnonzero((losses <= limit) & (losses < NEVER))
            places = sorted(near[np.argsort(losses[near], kind="stable")][:wanted].tolist())
            ways = []
            for at in places:
                found = self.search(chunks[at], self.n)
                ways.append([(found[0][0] - score, self._ids(chunks[at], cuts)) for score, cuts in found])
            # the best ids between the places, which every path shares
            cuts = [0] + [x for at in places for x in (begins[at], begins[at + 1] if at + 1 < len(begins) else len(ids))] + [len(ids)]
            shared = [ids[a:b].tobytes() for a, b in zip(cuts[::2], cuts[1::2])]
            options = sorted((sum(loss for loss, _ in picks), k, picks) for k, picks in enumerate(itertools.product(*ways)))
            for loss, _, picks in options[1 : self.n]:
                parts = [x for between, (_, own) in zip(shared, picks) for x in (between, own)]
                out.append((total - loss, b"".join([*parts, shared[-1]]), [(chunks[at], own) for at, (_, own) in zip(places, picks)]))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids in the form that encode gives."""
        return self.join(ids)[1:]

    def join(self, ids: bytes) -> str:
        """The pieces of ids, one after the other."""
        return b"".join(map(self.text.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode()


PATHS = "n_paths int, n_tokens long, score double, scores array<double>, crc32s array<long>, round_trip boolean"


def _digest(vocabulary: Vocabulary, text: str | None) -> tuple:
    paths = vocabulary.paths(text)
    scores, marks = [score / UNIT for score, _, _ in paths], [zlib.crc32(ids) for _, ids, _ in paths]
    # the best path is decoded whole, the others where they differ from it
    same = vocabulary.decode(paths[0][1]) == (text or "") and all(
        vocabulary.join(ids) == chunk for _, _, changed in paths for chunk, ids in changed)
    return (len(paths), len(paths[0][1]) // 4, scores[0], scores, marks, same), paths[0][1]


def encode(docs: DataFrame, model_path: str, n: int = 4, with_ids: bool = True, room: int = 600_000) -> DataFrame:
    """Per row of docs, its columns but the text, and the columns of PATHS; with_ids adds the best path as `ids`.

    scores and crc32s (of the ids as little-endian unsigned 32-bit numbers) are of the n best paths;
    round_trip says that each of them decodes to the text. A worker keeps the answers for up to
    `room` chunks, about 200 bytes each.
    """
    added = [part.split()[0] for part in PATHS.split(", ")] + ["ids"] * with_ids
    kept = [f for f in docs.schema.fields if f.name != "text" and f.name not in added]

    @F.pandas_udf(", ".join([PATHS, *["ids array<int>"] * with_ids]))
    def segmented(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = kept_by_worker(f"pieces {model_path} {n} {room}", lambda: Vocabulary(model_path, n, room))
        for texts in batches:
            for at in range(0, len(texts), 1000):  # keeps what a task holds small
                rows = [_digest(vocabulary, text) for text in texts.iloc[at : at + 1000]]
                frame = pd.DataFrame([row for row, _ in rows], columns=added[:6])
                if with_ids:
                    frame["ids"] = [np.frombuffer(ids, dtype="<i4") for _, ids in rows]
                yield frame

    found = docs.withColumn("_paths", segmented("text"))
    return found.select(*[f.name for f in kept], *[F.col("_paths")[c].alias(c) for c in added])


def op3_pieces(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tripgauge.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=False)
