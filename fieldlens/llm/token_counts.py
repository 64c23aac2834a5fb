"""Token counts of every prefix of a text, by dynamic programming over byte-pair encodings.

Within one pre-token the encoding of a prefix is the encoding of a shorter prefix
plus one token: the only token that ends there and can stand behind the shorter
prefix's last token. So one table of last tokens and counts, filled from left to
right, holds the exact count of every prefix. Two tokens can stand side by side
when no merge across their seam comes before the merges that use up its two
sides; that is read off the right edge of the one and the left edge of the
other token's merge tree (``Vocabulary.beside``) and remembered.

A text is the sequence of its pre-tokens, so its prefix counts are sums. ``steps``
stores them: per code point the change of the count (signed 16-bit, little-endian),
so the count of the first k code points is the sum of the first k steps. A prefix
is counted as the library counts that prefix as a text of its own: white space
before a word, contractions and special tokens that are still incomplete included.
``ledger`` stores the steps; ``answers`` reads limits and cuts from them and encodes
nothing again.

Pieces between single spaces or line breaks repeat, so their steps are kept by each
worker in two generations of bounded bytes. Characters outside a known range are put
into the tokenizer's classes (letter, number, white space, other) by asking its own
pre-tokenizer once a character.

Defined results: null and empty texts have 0 bytes, tokens and steps; the name of a special
token inside a text is that token, as the library reads it by default; null and repeated ids
are rows like any other; an empty table gives an empty ledger; only id and text are read.
Long texts take time in proportion to their length; one text's steps are one value.
"""

from __future__ import annotations

import gc
import itertools
import json
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import read_table, shared_folder, whole
from .token_files import BATCH_CHARS, BATCH_ROWS, TOKENIZER, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 1024
HELD_BYTES = 150 << 20    # of a generation of pieces
HELD_PAIRS = 1_000_000
HELD_PIECE = 64           # code points; longer pieces are not kept

# Characters whose class needs no question: ASCII white space, printable ASCII, Latin letters, common signs.
ODD = re.compile("[^\t-\r -~¡-©«-±´¶-¸»¿-ɏ]")
# A run of white space with the pre-token behind it; contractions only where no space stands before them.
UNIT = re.compile(r"(\s*)((?<! )'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d+|(?:[^\s\w\0]|_)+)|(\s+)|(\0)")
MARKS = frozenset(",.;:!?")
CUT = re.compile(r"(?<=\S)(?=\s\S)")


class Vocabulary:
    """Tokens and merges of a byte-level tokenizer, as byte strings with their ranks."""

    def __init__(self, spec: dict) -> None:
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]   # bytes written as themselves
        other = (b for b in range(256) if b not in set(plain))
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        raw = lambda s: bytes(byte_of[c] for c in s)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.parts = {a + b: (a, b, rank) for (a, b), rank in self.merges.items()}
        tokens = {raw(t) for t in spec["model"]["vocab"]}
        if set(self.parts) | {bytes([b]) for b in range(256)} != tokens or len(self.parts) != len(self.merges):
            raise ValueError("the tokens are not the bytes and one token per merge")
        self.edges: dict[tuple[bytes, bool], list[tuple[bytes, int]]] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        # A token counts only if its own bytes are encoded as it; shorter tokens first.
        self.tokens = {bytes([b]) for b in range(256)}
        for t in sorted(self.parts, key=len):
            a, b, rank = self.parts[t]
            if a in self.tokens and b in self.tokens and self._quiet(a, b, rank):
                self.tokens.add(t)
        self.lengths: dict[bytes, list[int]] = {}   # of the tokens with the same last two bytes, longest first
        for t in sorted(self.tokens, key=len, reverse=True):
            if len(t) > 1 and len(t) not in (known := self.lengths.setdefault(t[-2:], [])):
                known.append(len(t))

    def _edge(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """Nodes along one edge of the token's merge tree with the rank of the merge that uses each up."""
        key = (token, right)
        if key not in self.edges:
            out, rank = [], len(self.merges)   # the token itself is never used up
            while True:
                out.append((token, rank))
                if token not in self.parts:
                    break
                a, b, rank = self.parts[token]
                token = b if right else a
            self.edges[key] = out
        return self.edges[key]

    def _quiet(self, a: bytes, b: bytes, before: int) -> bool:
        """No merge across the seam of a and b of a rank under ``before`` while both its sides are there.

        Equal ranks go from left to right: a left side is used up first, a right side only afterwards.
        """
        for x, used_x in self._edge(a, True):
            for y, used_y in self._edge(b, False):
                rank = self.merges.get((x, y))
                if rank is not None and rank < before and rank < used_x and rank <= used_y:
                    return False
        return True

    def beside(self, a: bytes, b: bytes) -> bool:
        """True when the bytes of a and b together are encoded as these two tokens."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= HELD_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._quiet(a, b, len(self.merges))
        return known

    def prefix_counts(self, pieces: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of each prefix of each pre-token, by number of bytes from 0.

        Neighbours keep the table of the prefix they share, so sorted pieces solve each distinct prefix once.
        """
        tokens, lengths, pairs, beside = self.tokens, self.lengths, self.pairs, self.beside
        last: list[bytes] = [b""]
        counts = [0]
        before = b""
        for piece in pieces:
            same, most = 0, min(len(piece), len(before))
            while same < most and piece[same] == before[same]:
                same += 1
            before = piece
            del last[same + 1:], counts[same + 1:]
            for end in range(same + 1, len(piece) + 1):
                for n in lengths.get(piece[end - 2:end], ()) if end > 1 else ():
                    if n <= end:
                        start = end - n
                        token = piece[start:end]
                        if token in tokens:
                            fits = start == 0 or pairs.get((last[start], token))
                            if beside(last[start], token) if fits is None else fits:
                                break
                else:
                    start, token = end - 1, piece[end - 1:end]   # what is left over: one byte
                last.append(token)
                counts.append(counts[start] + 1)
            yield counts


class Counter:
    """Steps of whole texts."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path) as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if (pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or spec.get("normalizer")
                or spec.get("post_processor") or spec["model"].get("ignore_merges") or spec["model"]["type"] != "BPE"):
            raise ValueError("only byte-level BPE without normalizer and post-processor is counted by prefixes")
        special = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in special):
            raise ValueError("special tokens must stand for their own characters only")
        names = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.vocabulary = Vocabulary(spec)
        self.classes: dict[int, str] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    # -------------------------------------------------------------- pieces
    def _class(self, char: str) -> str:
        """A stand-in of the same class for a character that is not in the known range."""
        for probe, stand_in in (("a", "x"), ("1", "0"), ("!", "!")):
            if len(self.split(probe + char)) == 1:
                return stand_in
        return "\t"

    def _plain(self, text: str) -> str:
        """The text with stand-ins for odd characters, of equal length."""
        odd = set(ODD.findall(text)) - {"\0"}
        for c in odd:
            if ord(c) not in self.classes:
                self.classes[ord(c)] = self._class(c)
        return text.translate(self.classes) if odd else text

    def _counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of one pre-token, by number of code points, from 0."""
        return self._by_char(piece, next(self.vocabulary.prefix_counts([piece.encode()])))

    @staticmethod
    def _by_char(piece: str, counts: list[int]) -> list[int]:
        if len(counts) == len(piece) + 1:
            return counts
        return [0, *[counts[i] for i in itertools.accumulate(len(c.encode()) for c in piece)]]

    def _run(self, text: str, spaces: int, contraction: bool) -> list[int]:
        """Counts after each code point of a unit that is no plain pre-token: a run of white space with what follows, or a contraction."""
        counts = self._counts
        if spaces == len(text):
            return counts(text)[1:]
        own = text[spaces:]
        if contraction:  # incomplete, it is an apostrophe and letters
            first = counts("'")[1]
            tail = [first, *(first + n for n in counts(own[1:-1])[1:]), counts(own)[-1]]
        else:
            tail = counts(own)[1:]
        if not spaces:
            return tail
        run = counts(text[:spaces])[1:]   # cut inside the run, all of it is one pre-token
        before = run[-2] if spaces > 1 else 0
        if text[spaces - 1] == " ":       # the last space belongs to the word
            return run + [before + n for n in counts(text[spaces - 1:])[2:]]
        return run + [before + counts(text[spaces - 1])[1] + n for n in tail]

    def _units(self, pieces: list[str]) -> tuple[list[list[str]], dict[str, tuple[int, bool]]]:
        """The units of each piece, and white space and kind of those that aren't plain pre-tokens (at most one space before it)."""
        joined, runs, out, now = "\0".join(pieces), {}, [], []
        plain = self._plain(joined)
        for m in UNIT.finditer(plain if len(pieces) > 1 else plain.replace("\0", "!")):
            own, spaces = m[2], m[1] if m[3] is None else m[3]
            if m[4]:
                out.append(now)
                now = []
                continue
            unit = joined[m.start():m.end()]
            n = len(spaces or "")
            contraction = bool(own) and own[0] == "'" and own[1:2].isalpha()
            if n == 1 and spaces != " " and own and not contraction:
                now += [unit[0], unit[1:]]   # the white space is a pre-token of its own
                continue
            if contraction or n > 1:
                runs[unit] = (n, contraction)
            now.append(unit)
        return [*out, now], runs

    def _solve(self, pieces: list[str]) -> dict[str, bytes]:
        """Steps of pieces and of their units; a piece begins where a pre-token begins and ends where a text may end."""
        simple, rest, marked = [], [], {}
        for p in pieces:   # the usual pieces need no pattern: a space and a word, perhaps with a mark behind it
            if p[:1] == " " and not ODD.search(p):
                if p[1:].isalpha():
                    simple.append(p)
                    continue
                if p[-1] in MARKS and p[1:-1].isalpha():
                    marked[p] = [p[:-1], p[-1]]
                    continue
            rest.append(p)
        cut, runs = self._units(rest) if rest else ([], {})
        pieces, cut = [*simple, *marked, *rest], [*[[p] for p in simple], *marked.values(), *cut]
        known = {u: s for u in set().union(*cut) if (s := self.young.get(u)) is not None}
        plain = sorted((u.encode(), u) for u in set().union(*cut) if u not in known and u not in runs)
        solved = self.vocabulary.prefix_counts(data for data, _ in plain)
        made = ((u, self._by_char(u, counts)[1:]) for (_, u), counts in zip(plain, solved))
        special = ((u, self._run(u, *kind)) for u, kind in runs.items() if u not in known)
        for u, counts in itertools.chain(made, special):
            steps = array("h", map(int.__sub__, counts, [0, *counts[:-1]]))
            if sys.byteorder == "big":
                steps.byteswap()
            known[u] = steps.tobytes()
        return known | {p: b"".join(map(known.__getitem__, units)) for p, units in zip(pieces, cut) if len(units) != 1}

    def _steps(self, text: str) -> bytes:
        return self._find({text})[text]

    def _find(self, pieces: set[str]) -> dict[str, bytes]:
        """Steps of pieces that the young generation lacks: from the old one, or solved."""
        found, new = {}, []
        for p in pieces:
            steps = self.old.get(p)
            if steps is None:
                new.append(p)
            else:
                found[p] = steps
        odd = [p for p in new if "\0" in p]   # elsewhere it separates pieces
        for some in [[p for p in new if "\0" not in p], *[[p] for p in odd]]:
            found.update(self._solve(some) if some else {})
        for p, steps in found.items():
            self._hold(p, steps)
        return found

    def _hold(self, piece: str, steps: bytes) -> None:
        if len(piece) <= HELD_PIECE and piece not in self.young:
            self.young[piece] = steps
            self.held += 3 * len(piece) + 200   # the two objects and the entry, roughly

    # -------------------------------------------------------------- texts
    @staticmethod
    def _pieces(text: str) -> list[str]:
        """Cut before each single white space between other characters: a pre-token begins there."""
        if "  " in text or "\n " in text or " \n" in text or "\n\n" in text or any(c in text for c in "\t\r\x0b\x0c") or ODD.search(text):
            return CUT.split(text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")

    def _with_special(self, text: str) -> bytes:
        """A text that holds names of special tokens: each is one token and ends the text before it."""
        import numpy as np

        out, at = [], 0
        for m in self.special.finditer(text):
            before, name = text[at:m.start()], m[0]
            open_steps = np.frombuffer(self._steps(before + name), "<i2").copy()   # the name is ordinary text until it is complete
            closed = int(np.frombuffer(self._steps(before), "<i2").sum(dtype="i8")) + 1
            open_steps[-1] = closed - int(open_steps[:-1].sum(dtype="i8"))
            out.append(open_steps.tobytes())
            at = m.end()
        return b"".join(out) + self._steps(text[at:])

    def steps(self, texts: list[str]) -> list[bytes]:
        """The steps of each text."""
        marked = [bool(self.special and self.special.search(t)) for t in texts]
        split, found, gaps = [], [], []
        for t, m in zip(texts, marked):  # one look-up a piece; what is missing is filled in below
            pieces = [] if m else self._pieces(t)
            steps = list(map(self.young.get, pieces))
            split.append(pieces)
            found.append(steps)
            gaps.append([i for i, x in enumerate(steps) if x is None] if None in steps else [])
        made = self._find({pieces[i] for pieces, where in zip(split, gaps) for i in where})
        for pieces, steps, where in zip(split, found, gaps):
            for i in where:
                steps[i] = made[pieces[i]]
        out = [self._with_special(t) if m else b"".join(steps) for t, m, steps in zip(texts, marked, found)]
        if self.held > HELD_BYTES:
            self.old, self.young, self.held = self.young, {}, 0
        return out


def _counter(path: str) -> Counter:
    """One counter per Python worker, so its pieces outlive a task."""
    held = sys.modules.setdefault("_token_counters", types.ModuleType("_token_counters"))
    if path not in held.__dict__:
        held.__dict__[path] = Counter(path)
        gc.freeze()   # the vocabulary stays; collections needn't look at it
    return held.__dict__[path]


# ------------------------------------------------------------------ tables
def ledger(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_chars, n_tokens and ``steps`` of every row."""
    import pyarrow as pa

    t = whole(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.octet_length(t).cast("long").alias("n_bytes"), t.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        counter = _counter(tokenizer)
        for b in batches:
            texts = b.column("text").to_pylist()
            chars = [0, *itertools.accumulate(map(len, texts))]
            low = 0
            while low < len(texts):
                high = low + 1
                while high < len(texts) and chars[high + 1] - chars[low] <= BATCH_CHARS:
                    high += 1
                steps = counter.steps(texts[low:high])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(low, high - low), b.column("n_bytes").slice(low, high - low),
                     pa.array([len(s) // 2 for s in steps], pa.int64()),
                     pa.array([int(np.frombuffer(s, "<i2").sum(dtype="i8")) for s in steps], pa.int64()), pa.array(steps, pa.binary())],
                    names=["doc_id", "n_bytes", "n_chars", "n_tokens", "steps"])
                low = high

    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_chars long, n_tokens long, steps binary")


def write_ledger(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    with small_batches(docs.sparkSession, BATCH_ROWS):
        ledger(docs, tokenizer, doc_id, text).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def prefix_count(steps: bytes, chars: int) -> int:
    """Tokens of the first ``chars`` code points."""
    import numpy as np

    return int(np.frombuffer(steps, "<i2", max(0, min(chars, len(steps) // 2))).sum(dtype="i8"))


def longest_prefix(steps: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    import numpy as np

    fits = np.flatnonzero(np.cumsum(np.frombuffer(steps, "<i2"), dtype="i8") <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def answers(rows: DataFrame, budget: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and ``cut_chars`` (longest prefix within the budget) from stored steps."""
    import pyarrow as pa

    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            steps = b.column("steps")
            whole_text = [prefix_count(s.as_buffer(), n) for s, n in zip(steps, b.column("n_chars").to_pylist())]
            cut = [n if t <= budget else longest_prefix(s.as_buffer(), budget)
                   for s, n, t in zip(steps, b.column("n_chars").to_pylist(), whole_text)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_bytes"), pa.array(whole_text, pa.int64()), pa.array(cut, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens", "cut_chars"])

    return rows.select("doc_id", "n_bytes", "n_chars", "steps").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, cut_chars long")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_folder(spark, "token-counts")
    rows = write_ledger(read_table(spark, sf_dir, "documents"), f"{folder}/ledger", public_tokenizers.path(TOKENIZER))
    with small_batches(spark, BATCH_ROWS):
        answers(rows, LIMIT).write.parquet(f"{folder}/answers")
    return spark.read.parquet(f"{folder}/answers").withColumn("over_limit", F.col("n_tokens") > LIMIT)
