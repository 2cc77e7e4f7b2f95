"""SentencePiece BPE encoding by backtracking, and decoding.

A text's spaces become U+2581, one more is put in front, and the text is cut
before each run of them; no piece reaches over such a cut, which is checked when
a model is loaded.  Each chunk is encoded on its own: an Aho-Corasick automaton
finds the longest piece that begins at every position, and a search takes the
longest piece that is compatible with the piece before it.  Two pieces are
compatible if merging the characters of their joined text from scratch gives
those two pieces again.  Pieces of spaces alone are merged after all others, so the
further spaces of a run are merged by themselves.  Where no piece fits, the search takes back its last
piece and marks the position as failed in a bit field, so no position is tried
twice.  Characters outside the vocabulary become their UTF-8 bytes.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache
from math import inf

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from rillwork.llm.common import add_columns

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Words whose ids a worker remembers, twice so many at most, and the longest one.
KEPT_CHUNKS = 200_000
KEPT_LENGTH = 48
#: Pairs of pieces whose verdict a task remembers.
KEPT_PAIRS = 200_000


class Codec:
    """Encoder and decoder of one model file.

    Covers models of merge type with byte fallback, identity normalization, a
    dummy prefix, and normal, control, unknown and byte pieces; others are
    refused.
    """

    def __init__(self, model_file: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as file:
            model.ParseFromString(file.read())
        trainer, norm = model.trainer_spec, model.normalizer_spec
        if (
            trainer.model_type != 2
            or not trainer.byte_fallback
            or trainer.treat_whitespace_as_suffix
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not norm.add_dummy_prefix
            or not norm.escape_whitespaces
            or model.denormalizer_spec.precompiled_charsmap
            or {p.type for p in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError("not a merge model with byte fallback and identity normalization")
        self.texts = [p.piece for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        merged = [r for t, r in self.rank.items() if len(t) > 1 and t.strip(SPACE)]
        blank = [r for t, r in self.rank.items() if not t.strip(SPACE)]
        if len(set(merged)) < len(merged) or min(blank) <= max(merged):
            raise ValueError("scores leave the order of merges open")
        if any(re.search(f"[^{SPACE}]{SPACE}|{SPACE}{SPACE}[^{SPACE}]", t) for t in self.ids):
            raise ValueError("a piece goes on after a space or begins with several")
        self.byte_ids = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[1:-1], 16)] = i
        self.end = trainer.eos_id
        self.surfaces = [
            b"" if p.type == CONTROL
            else trainer.unk_surface.encode() if p.type == UNKNOWN
            else bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE
            else p.piece.replace(SPACE, " ").encode()
            for p in model.pieces
        ]
        self.control = {i for i, p in enumerate(model.pieces) if p.type == CONTROL}
        self.single_bytes = {i for i, p in enumerate(model.pieces) if p.type == BYTE}
        # A piece that its own characters do not merge into never comes out of merging.
        usable = [t for t in self.ids if (t.strip(SPACE) or t == SPACE) and self.merge(t) == [t]]
        self.automaton = ahocorasick.Automaton()
        for t in usable:
            self.automaton.add_word(t, (len(t), t))
        self.automaton.make_automaton()
        known = set(usable)
        self.shorter = {
            t: next((t[:n] for n in range(len(t) - 1, 0, -1) if t[:n] in known), None) for t in usable
        }
        # Ends of pieces, worked out when they are first met.
        self.right_ends: dict[str, tuple] = {}
        self.left_ends: dict[str, tuple] = {}
        self.fits: dict[str, dict[str, bool]] = {t: {} for t in usable}
        self.n_fits = 0
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def last_merge(self, piece: str) -> tuple[str, str]:
        """The two parts that a piece is merged from in the end."""
        left, right = self.merge(piece, without=piece)
        return left, right

    def merge(self, text: str, without: str = "") -> list[str]:
        """Merge the characters of ``text``, always the best-ranked neighbours, leftmost first.

        ``without`` is a piece that is not made.
        """
        parts: list[str | None] = list(text)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = self.rank
        heap = [(rank[p], i, p) for i in range(n - 1) if (p := text[i : i + 2]) in rank and p != without]
        heapq.heapify(heap)
        while heap:
            _, i, piece = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or parts[i] + parts[j] != piece:
                continue
            parts[i], parts[j] = piece, None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                if left >= 0 and after[left] < n:
                    joined = parts[left] + parts[after[left]]
                    if joined in rank and joined != without:
                        heapq.heappush(heap, (rank[joined], left, joined))
        return [p for p in parts if p is not None]

    def spine(self, piece: str, side: int) -> tuple:
        """What stands at one end of a piece while it is merged: (part, rank of the merge that takes it in).

        ``side`` 0 is the left end, -1 the right end.
        """
        parts, found = [piece], []
        taken = inf
        while True:
            part = parts[side]
            found.append((part, taken))
            if len(part) == 1:
                return tuple(reversed(found))
            taken = self.rank[part]
            parts = self.last_merge(part)

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the characters of both pieces gives the two pieces again.

        Merges inside either piece do not depend on the other one until something
        is merged over the seam, so only the parts at the seam are merged anew, in
        the order of their ranks; of equal ranks the left one goes first.
        """
        lefts, rights = self.right_ends.get(left), self.left_ends.get(right)
        if lefts is None:
            lefts = self.right_ends[left] = self.spine(left, -1)
        if rights is None:
            rights = self.left_ends[right] = self.spine(right, 0)
        rank = self.rank
        i = j = 0
        while True:
            (a, a_taken), (b, b_taken) = lefts[i], rights[j]
            over = rank.get(a + b)
            if over is not None and over < a_taken and over <= b_taken:
                return False
            if a_taken <= b_taken:
                if a_taken == inf:
                    return True
                i += 1
            else:
                j += 1

    def judged(self, left: str, right: str) -> bool:
        """``compatible``, remembered."""
        if self.n_fits >= KEPT_PAIRS:
            for verdicts in self.fits.values():
                verdicts.clear()
            self.n_fits = 0
        self.n_fits += 1
        verdict = self.fits[left][right] = self.compatible(left, right)
        return verdict

    def search(self, text: str, longest: list[str | None]) -> list[str]:
        """Pieces of a text of which every character is a piece."""
        taken: list[str] = []
        fits, shorter, judged = self.fits, self.shorter, self.judged
        failed, at, n = 0, 0, len(text)
        piece = longest[0]
        verdicts = None
        while True:
            while piece is not None:
                end = at + len(piece)
                if not (failed and failed >> end & 1):
                    if verdicts is None:
                        break
                    fit = verdicts.get(piece)
                    if fit is None:
                        fit = judged(taken[-1], piece)
                    if fit:
                        break
                piece = shorter[piece]
            if piece is not None:
                taken.append(piece)
                if end == n:
                    return taken
                at = end
                verdicts = fits[piece]
                piece = longest[at]
            else:
                failed |= 1 << at
                piece = taken.pop()
                at -= len(piece)
                verdicts = fits[taken[-1]] if taken else None

    def chunk(self, text: str) -> tuple[int, ...]:
        """Ids of one chunk: a run of spaces and what follows up to the next run."""
        word = text.lstrip(SPACE)
        spaces = len(text) - len(word)
        if not word:
            return tuple([self.ids[p] for p in self.merge(text)])
        if not spaces:
            return tuple(self.word(word))
        ids = self.word(SPACE + word)
        if spaces == 1:
            return tuple(ids)
        if ids[0] == self.ids[SPACE]:
            ids = ids[1:]
        else:
            spaces -= 1
        return (*[self.ids[p] for p in self.merge(SPACE * spaces)], *ids)

    def word(self, text: str) -> list[int]:
        """Ids of a text without runs of spaces."""
        longest: list[str | None] = [None] * len(text)
        for end, (length, piece) in self.automaton.iter(text):
            longest[end - length + 1] = piece
        ids = self.ids
        if None not in longest:
            return [ids[p] for p in self.search(text, longest)]
        out: list[int] = []
        start = 0
        while start < len(text):
            if longest[start] is None:
                out.extend([self.byte_ids[b] for b in text[start].encode()])
                start += 1
                continue
            end = next((i for i in range(start, len(text)) if longest[i] is None), len(text))
            out.extend([ids[p] for p in self.search(text[start:end], longest[start:end])])
            start = end
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, the end id last."""
        out: list[int] = []
        if text:
            chunks, spaces = self.chunks, 0
            for word in text.replace(SPACE, " ").split(" "):
                # One space belongs to every word, the first one's is the dummy prefix;
                # an empty word is one more space of a run.
                if not word:
                    spaces += 1
                    continue
                if spaces:
                    out += self.chunk(SPACE * (spaces + 1) + word)
                    spaces = 0
                    continue
                ids = chunks.get(word)
                if ids is None:
                    ids = self.older.get(word) or self.chunk(SPACE + word)
                    if len(word) <= KEPT_LENGTH:
                        if len(chunks) >= KEPT_CHUNKS:
                            # Words that come again move from the older half to the newer one.
                            self.older, self.chunks = chunks, {}
                            chunks = self.chunks
                        chunks[word] = ids
                out += ids
            if spaces:
                out += self.chunk(SPACE * spaces)
        out.append(self.end)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of any valid ids.

        Control ids give nothing, the space that begins the first shown piece goes,
        and bytes that are no UTF-8 become U+FFFD one by one.
        """
        first = next((i for i in ids if i not in self.control), None)
        if first is None:
            return ""
        surfaces = self.surfaces
        if not self.control.isdisjoint(ids[:-1]):
            return self._decode_apart(ids, first)
        whole = b"".join([surfaces[i] for i in ids])
        if self.texts[first].startswith(SPACE):
            whole = whole[1:]
        try:
            return whole.decode()
        except UnicodeDecodeError:
            return self._decode_apart(ids, first)

    def _decode_apart(self, ids: list[int], first: int) -> str:
        out, run, fresh = [], bytearray(), True

        def flush():
            at = 0
            while at < len(run):
                for n in (1, 2, 3, 4):
                    try:
                        out.append(bytes(run[at : at + n]).decode())
                        at += n
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("\ufffd")
                    at += 1
            run.clear()

        for i in ids:
            if i in self.single_bytes:
                run += self.surfaces[i]
                fresh = False
                continue
            flush()
            shown = self.surfaces[i].decode()
            if fresh and i == first and self.texts[i].startswith(SPACE):
                shown = shown[1:]
            fresh = fresh and i in self.control
            out.append(shown)
        flush()
        return "".join(out)


@lru_cache(maxsize=1)
def codec(model_file: str) -> Codec:
    """One codec per worker process; its model is read from a path that every machine has."""
    return Codec(model_file)


def encode(
    df: DataFrame, model_file: str, text: str = "text", ids: str = "ids", keep_text: bool = True
) -> DataFrame:
    """Add the ids of every whole text with the end id last; a null text counts as empty.

    Empty texts give the end id alone, long texts are encoded whole, repeated rows
    are encoded like any others, an empty table stays empty, and a column that has
    the name of the new one is replaced.
    """

    def make():
        of = codec(model_file).encode
        return lambda value: (of(value.decode() if value else ""),)

    return add_columns(df, [text], [(ids, T.ArrayType(T.IntegerType()))], make, [] if keep_text else [text])


def decode(df: DataFrame, model_file: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text of every list of ids; null and empty lists give an empty text."""

    def make():
        of = codec(model_file).decode
        return lambda value: (of(value or []),)

    return add_columns(df, [ids], [(text, T.StringType())], make)


def encode_and_decode(
    df: DataFrame, model_file: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Replace every text by its ids and by the text of these ids, in one pass through Python.

    The same as ``encode`` and then ``decode``, but a task needs one worker with one
    codec, not two.  Nulls, empty texts and clashing names as there.
    """

    def make():
        of = codec(model_file)

        def row(value):
            made = of.encode(value.decode() if value else "")
            return made, of.decode(made)

        return row

    fields = [(ids, T.ArrayType(T.IntegerType())), (decoded, T.StringType())]
    return add_columns(df, [text], fields, make, [text])


def digests(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> list:
    """Columns that identify ids and text: count and digest of the ids, digest of the text."""
    return [
        F.size(ids).cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    ]
