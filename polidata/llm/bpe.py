"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its decoder.

A word's symbols enter a buffer; a token leaves it as soon as no later symbol can change it.  How many
symbols past a token's end must be known follows from the merge list alone (`sufficient_lookahead`), so
the buffer stays constant however long a word is.  Normalisation and splitting follow the tokenizer
file.  Decoding feeds ids to a state machine that keeps only the unfinished bytes of a character.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: A text is cut at blanks into parts of about so many characters.
PART_CHARS = 1 << 16
#: Longer words are not remembered.
CACHED_WORD_CHARS = 48
#: Words in either half of the cache.
CACHE_WORDS = 250_000
# The split pattern of a byte-level pre-tokenizer whose file asks for its own (a fixed value).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    return [x for _, x in sorted([(b, chr(b)) for b in plain] + [(b, chr(256 + i)) for i, b in enumerate(others)])]


def sufficient_lookahead(merges: list[tuple[str, str]], length=len) -> int:
    """Symbols past a token's end that decide whether the merge list leaves the token as it is.

    A token can only be taken from the right by a merge (x, y) whose x ends where the token ends, i.e. x
    is on the token's right spine, and only if y stands there by then: it was formed, and nothing took it
    from the right, by merges earlier in the list.  Both are known some symbols past y's end.  reach[x]
    is the largest length of y plus that over the merges (x, y) so far; one pass in order settles it.
    """
    spine: dict[str, tuple[str, ...]] = {}
    need: dict[str, int] = {}
    reach: dict[str, int] = {}
    for x, y in merges:
        token, right = x + y, spine.get(y, (y,))
        known = max([need.get(y, 0), *(reach.get(t, 0) for t in right)])
        need[token] = max(need.get(token, 0), known)
        spine.setdefault(token, (token, *right))
        reach[x] = max(reach.get(x, 0), length(y) + known)
    return max(reach.values(), default=0)


class Tokenizer:
    """A BPE tokenizer file of the kinds in use here; other settings are refused, never ignored."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model = j["model"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges", "fuse_unk")):
            raise ValueError("not a plain BPE model")
        self.ids: dict[str, int] = model["vocab"]
        self.merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(self.merges)}
        self.end = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in j.get("added_tokens", [])):
            raise ValueError("added tokens with conditions")
        self.steps = self._steps(j.get("normalizer"))
        self.split = self._split(j.get("pre_tokenizer"))
        kind = (j.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"decoder {kind}")
        self.joins_bytes = kind == "ByteLevel"
        self.texts = {i: t for t, i in {**self.ids, **self.added}.items()}
        self.chars = byte_alphabet()
        self.bytes = {c: b for b, c in enumerate(self.chars)}
        self.special = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        self.cache = WordCache(self)

    @staticmethod
    def _steps(spec: dict | None) -> list:
        steps = []
        for s in [] if spec is None else spec["normalizers"] if spec["type"] == "Sequence" else [spec]:
            if s["type"] == "NFC":
                steps.append(lambda t: t if t.isascii() else unicodedata.normalize("NFC", t))
            elif s["type"] == "Lowercase":  # letter by letter: str.lower() would look around a final sigma
                steps.append(lambda t: t.lower() if "Σ" not in t else t.replace("Σ", "σ").lower())
            elif s["type"] == "Replace" and "Regex" in s["pattern"]:
                steps.append(lambda t, p=regex.compile(unicode_blanks(s["pattern"]["Regex"])), c=s["content"].replace("\\", r"\\"): p.sub(c, t))
            else:
                raise ValueError(f"normalizer {s['type']}")
        return steps

    @staticmethod
    def _split(spec: dict) -> regex.Pattern:
        pattern, byte_level = None, False
        for s in spec["pretokenizers"] if spec["type"] == "Sequence" else [spec]:
            if s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"]:
                pattern = s["pattern"]["Regex"]
            elif s["type"] == "ByteLevel" and not s["add_prefix_space"]:
                byte_level, pattern = True, BYTE_LEVEL_PATTERN if s["use_regex"] else pattern
            else:
                raise ValueError(f"pre-tokenizer {s['type']}")
        if not byte_level or pattern is None:
            raise ValueError("only byte-level pre-tokenizers")
        return regex.compile(unicode_blanks(pattern))

    @cached_property
    def lookahead(self) -> int:
        return sufficient_lookahead(self.merges, lambda t: len(t.removesuffix(self.end)) if self.end else len(t))

    # ---- encoding

    def parts(self, text: str) -> Iterator[str | int]:
        """The text between added tokens, cut before blanks into bounded parts, and added tokens' ids."""
        at = 0
        for m in self.special.finditer(text):
            yield from bounded(text, at, m.start())
            yield self.added[m.group()]
            at = m.end()
        yield from bounded(text, at, len(text))

    def pieces(self, part: str) -> list[str]:
        for step in self.steps:
            part = step(part)
        return self.split.findall(part)

    def merged(self, symbols: list[str]) -> list[str]:
        """The tokens that the merge list makes of these symbols."""
        rank, far = self.rank.get, len(self.rank)
        ranks = [rank(p, far) for p in zip(symbols, symbols[1:])]
        while ranks and (best := min(ranks)) < far:
            x, y = self.merges[best]
            i = ranks.index(best)
            while True:  # from left to right; an overlap goes to the left one
                symbols[i: i + 2] = [x + y]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank((symbols[i - 1], x + y), far)
                if i < len(ranks):
                    ranks[i] = rank((x + y, symbols[i + 1]), far)
                if best not in ranks[i + 1:]:
                    break
                i = ranks.index(best, i + 1)
        return symbols

    def tokens(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of a word from its stream of symbols, each as soon as it is stable."""
        buffer: list[str] = []
        room = 2 * self.lookahead + 256
        for s in symbols:
            buffer.append(s)
            if len(buffer) >= room:
                taken = 0
                for token in self.merged(buffer[:]):
                    n = len(token.removesuffix(self.end)) if self.end else len(token)
                    if taken + n + self.lookahead > len(buffer):
                        break
                    taken += n
                    yield token
                del buffer[:taken]
        yield from self.merged(buffer)

    def symbols(self, word: str) -> list[str]:
        """A word as characters for its bytes, the last one with the end mark."""
        letters = list(map(self.chars.__getitem__, word.encode("utf-8", "surrogatepass")))
        letters[-1] += self.end
        return letters

    def encode(self, text: str) -> Iterator[int]:
        """Ids of the whole text, in order."""
        for part in self.parts(text):
            if isinstance(part, int):
                yield part
            else:
                for word in self.pieces(part):
                    yield from (self.ids[t] for t in self.tokens(self.symbols(word)))

    # ---- decoding

    def decoder(self) -> Decoder:
        return Decoder(self)

    def decode(self, ids: Iterable[int]) -> str:
        state = self.decoder()
        return "".join([*map(state.feed, ids), state.finish()])

    # ---- both, for whole columns

    def digest(self, text: str | None) -> tuple[int, str, str]:
        """n_tokens, SHA-256 of the ids joined by one space, SHA-256 of the decoded text."""
        count, ids, texts = 0, hashlib.sha256(), hashlib.sha256()
        for part in self.parts(text or ""):
            words = [self.special_entry(part)] if isinstance(part, int) else list(map(self.cache.__getitem__, self.pieces(part)))
            if words:
                n, numbers, decoded = zip(*words)
                ids.update(((" " if count else "") + " ".join(numbers)).encode())
                between = "" if self.joins_bytes else " "
                texts.update(((between if count else "") + between.join(decoded)).encode("utf-8", "replace"))
                count += sum(n)
        return count, ids.hexdigest(), texts.hexdigest()

    def entry(self, word: str) -> tuple[int, str, str]:
        """Number of ids, ids as text and decoded text of one word; short ones need no streaming."""
        symbols = self.symbols(word)
        tokens = self.merged(symbols) if len(word) <= CACHED_WORD_CHARS else list(self.tokens(symbols))
        ids = list(map(self.ids.__getitem__, tokens))
        return len(ids), " ".join(map(str, ids)), self.decode(ids) if self.joins_bytes else " ".join(tokens)

    def special_entry(self, token: int) -> tuple[int, str, str]:
        return 1, str(token), self.texts[token]


class Decoder:
    """Incremental: feed() returns the text that an id completes and keeps the bytes of a cut character."""

    def __init__(self, tokenizer: Tokenizer):
        self.t, self.first = tokenizer, True
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, token: int) -> str:
        text = self.t.texts[token]
        if not self.t.joins_bytes:  # no decoder in the file: the tokens themselves, joined by spaces
            first, self.first = self.first, False
            return text if first else " " + text
        if all(c in self.t.bytes for c in text):
            return self.utf8.decode(bytes(self.t.bytes[c] for c in text))
        return self.utf8.decode(text.encode())

    def finish(self) -> str:
        return "" if not self.t.joins_bytes else self.utf8.decode(b"", True)


class WordCache(dict):
    """word -> (number of ids, ids as text, decoded text); two halves, of which the older one goes."""

    def __init__(self, tokenizer: Tokenizer, limit: int = CACHE_WORDS):
        super().__init__()
        self.t, self.limit, self.old = tokenizer, limit, {}

    def __missing__(self, word: str) -> tuple[int, str, str]:
        entry = self.old.get(word)
        if entry is None:
            entry = self.t.entry(word)
        if len(word) <= CACHED_WORD_CHARS:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[word] = entry
        return entry


def unicode_blanks(pattern: str) -> str:
    """\\s and \\S by the Unicode property, which some engines' \\s exceeds."""
    return pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def bounded(text: str, start: int, stop: int) -> Iterator[str]:
    """text[start:stop] in parts; each later part begins with a single blank before a word, where no
    normalisation or pattern reaches across."""
    while start < stop:
        cut = stop
        if stop - start > PART_CHARS:
            m = SAFE_CUT.search(text, start + PART_CHARS, stop)
            cut = m.start() + 1 if m else stop
        yield text[start:cut]
        start = cut


#: Between an ASCII letter and one space followed by an ASCII letter.
SAFE_CUT = regex.compile(r"[A-Za-z](?= [A-Za-z])")

DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ids (array<int>) and the decoded text of every row of docs(doc_id, text).

    NULL and empty texts have no ids and decode to an empty text; rows stay as they are repeated.
    """
    tokenizer_of = shipped(docs, vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer_of()
        for batch in batches:
            ids = [list(t.encode(x.as_py() or "")) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([t.decode(x) for x in ids], pa.string())],
                                             ["doc_id", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def token_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens and the two digests of every row of docs(doc_id, text); NULL texts are empty.

    Only doc_id and text are read, so other columns may have any names; an empty table gives no rows.
    """
    tokenizer_of = shipped(docs, vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer_of()
        for batch in batches:
            rows = [t.digest(x.as_py()) for x in batch.column(1)]
            n, ids, texts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {DIGESTS}")


_LOADED: dict[str, Tokenizer] = {}


def shipped(docs: DataFrame, vocabulary: str):
    """The vocabulary file, broadcast as text (a file of fixed size), and how a task gets its tokenizer."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def get() -> Tokenizer:
        if vocabulary not in _LOADED:
            _LOADED[vocabulary] = Tokenizer(spec.value)
        return _LOADED[vocabulary]

    return get
