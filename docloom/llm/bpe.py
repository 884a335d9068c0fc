"""BPE encoding and decoding by an automaton over token sequences.

Merge rules are compiled one after another into a deterministic automaton whose arcs carry
tokens.  It starts as one state with a loop for every symbol.  The gadget of rule
``(u, v) -> w`` lets no ``v`` follow ``u`` any more and adds ``w`` beside every path ``u v``:
whatever could precede ``u`` may precede ``w``, whatever could follow ``v`` may follow ``w``.
A state is thus known by the last token, and exactly one path spells each word: its encoding.
Rows of the arc table are filled as words ask for them.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from docloom.llm.common import text_or_empty

WORD_END = "</w>"
# A word of Latin letters and perhaps marks after it, no apostrophe among them.
PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")
# Fixed rule of byte-level vocabularies: bytes without a visible character of their own
# stand as those from U+0100 on, in order.
_HIDDEN = [*range(33), *range(127, 161), 173]
_SYMBOLS = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}
LONG_WORD = 64
# What a worker remembers, in entries of some hundred bytes each.
CACHE_CHUNKS = 400_000
CACHE_PREFIXES = 800_000
CACHE_ARCS = 600_000
SLICE_TOKENS = 1_000_000


class MergeAutomaton:
    """Token arcs of a merge list, and the one accepted path of a word."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.labels = {i: t for t, i in vocab.items()}
        self.vocab = vocab
        size = max(vocab.values(), default=0) + 1
        self.left, self.right = [-1] * size, [-1] * size
        self.born = [0] * size
        self.blocked: dict[int, int] = {}  # u * size + v -> the rule that took v from u's state
        self.size = size
        self.longest = max((len(t) for t in vocab), default=1)
        for step, (u, v) in enumerate(merges, 1):
            self._gadget(step, vocab[u], vocab[v], vocab[u + v])
        self.arcs: dict[int, bool] = {}
        self.prefixes: dict[str, int] = {"": -1}

    def _gadget(self, step: int, u: int, v: int, w: int) -> None:
        self.left[w], self.right[w], self.born[w] = u, v, step
        self.blocked[u * self.size + v] = step

    def arc(self, a: int, b: int) -> bool:
        """Whether the state after token ``a`` has an arc ``b`` once all rules are in."""
        key = a * self.size + b
        found = self.arcs.get(key)
        if found is None:
            if len(self.arcs) >= CACHE_ARCS:
                self.arcs.clear()
            found = self.arcs[key] = self._allowed(a, b, len(self.born) + len(self.blocked))
        return found

    def _allowed(self, a: int, b: int, upto: int) -> bool:
        """The same before rule ``upto``: follow the gadgets that made the younger token."""
        while True:
            taken = self.blocked.get(a * self.size + b)
            if taken is not None and taken < upto:
                return False
            born_a, born_b = self.born[a], self.born[b]
            if born_a == 0 and born_b == 0:
                return True
            if a == b:  # both ends of one gadget
                upto, a, b = born_a, self.right[a], self.left[b]
            elif born_b > born_a:  # b came in beside its left part
                if self.left[b] == self.right[b] == a:
                    return False  # of three equal tokens the first two are joined
                upto, b = born_b, self.left[b]
            else:  # a's state began as that of its right part
                upto, a = born_a, self.right[a]

    def _last(self, text: str) -> None:
        """Learns the token that ends the path of each prefix of ``text``."""
        prefixes, vocab, arcs, size = self.prefixes, self.vocab, self.arcs, self.size
        known = len(text)
        while text[:known] not in prefixes:
            known -= 1
        for end in range(known + 1, len(text) + 1):
            for begin in range(end - 1, max(0, end - self.longest) - 1, -1):
                token = vocab.get(text[begin:end])
                if token is None:
                    continue
                before = prefixes[text[:begin]]
                if before < 0 or (arcs.get(before * size + token) or self.arc(before, token)):
                    prefixes[text[:end]] = token
                    break
            else:
                raise ValueError(f"no path spells {text[:end]!r}")

    def encode(self, word: str) -> list[int]:
        """Token ids of one word of byte symbols; its last symbol carries the word end."""
        if len(word) > LONG_WORD:
            return self._encode_long(word)
        if len(self.prefixes) > CACHE_PREFIXES:
            self.prefixes = {"": -1}
        body, prefixes, vocab = word[:-1], self.prefixes, self.vocab
        if body:
            self._last(body)
        ended = word + WORD_END
        for begin in range(len(word) - 1, max(0, len(word) - self.longest) - 1, -1):
            token = vocab.get(ended[begin:])
            if token is not None:
                before = prefixes[word[:begin]]
                if before < 0 or self.arc(before, token):
                    break
        else:
            raise ValueError(f"no path spells {ended!r}")
        path, at = [token], begin
        while at > 0:
            token = prefixes[word[:at]]
            path.append(token)
            at -= len(self.labels[token])
        return path[::-1]

    def _encode_long(self, word: str) -> list[int]:
        """The same by position and without remembering prefixes: linear in the word."""
        vocab, size = self.vocab, len(word)
        last = [-1] * (size + 1)
        starts = [0] * (size + 1)
        for end in range(1, size + 1):
            tail = WORD_END if end == size else ""
            for begin in range(end - 1, max(0, end - self.longest) - 1, -1):
                token = vocab.get(word[begin:end] + tail)
                if token is not None and (begin == 0 or self.arc(last[begin], token)):
                    last[end], starts[end] = token, begin
                    break
            else:
                # A prefix that ends inside the word always has a path without the word end.
                raise ValueError(f"no path spells {size} symbols up to {end}")
        path, at = [], size
        while at > 0:
            path.append(last[at])
            at = starts[at]
        return path[::-1]

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, one blank between them."""
        return " ".join(self.labels[i] for i in ids)


class WordCoder:
    """Encodes blank-separated chunks of text, each distinct one once while it is remembered.

    Nothing in the file's normaliser or splitter reaches across white space, and its special
    strings hold none, so chunks may be coded apart.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.automaton = MergeAutomaton(spec["model"]["vocab"], merges)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.automaton.labels[i] = content
        tokenizer = Tokenizer.from_file(path)
        self.normalise = tokenizer.normalizer.normalize_str
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.ids: dict[str, str] = {}
        self.labels: dict[str, str] = {}
        self.words: dict[str, tuple[str, str]] = {}

    def _pieces(self, chunk: str):
        """The chunk cut at special strings: ``(text, special id or None)``."""
        while chunk:
            hits = [(chunk.find(s), -len(s), s) for s in self.special if s in chunk]
            if not hits:
                yield chunk, None
                return
            at, _, s = min(hits)
            if at:
                yield chunk[:at], None
            yield s, self.special[s]
            chunk = chunk[at + len(s) :]

    def chunk_words(self, chunk: str) -> list[tuple[str, str]]:
        """The ids and labels, each joined by one blank, of the words of a chunk."""
        plain = PLAIN.fullmatch(chunk)
        if plain:  # what the library's normaliser and splitter make of the usual chunk
            word = plain[1].lower()
            if not word.isascii():
                word = word.encode().decode("latin-1").translate(_SYMBOLS)
            return [self._word(word), self._word(plain[2])] if plain[2] else [self._word(word)]
        out: list[tuple[str, str]] = []
        for piece, special in self._pieces(chunk):
            if special is not None:
                out.append((str(special), self.automaton.labels[special]))
                continue
            out += [self._word(word) for word, _ in self.split(self.normalise(piece))]
        return out

    def _word(self, word: str) -> tuple[str, str]:
        known = self.words.get(word)
        if known is None:
            ids = self.automaton.encode(word)
            known = self.words[word] = (" ".join(map(str, ids)), self.automaton.decode(ids))
        return known

    def code(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, their ids and their labels, each joined by one blank."""
        chunks = text.replace("\n", " ").split(" ")
        for chunk in set(chunks).difference(self.ids):
            words = self.chunk_words(chunk)
            self.ids[chunk] = " ".join([w[0] for w in words])
            self.labels[chunk] = " ".join([w[1] for w in words])
        ids = " ".join(map(self.ids.__getitem__, chunks))
        if "  " in ids or ids[:1] == " " or ids[-1:] == " ":
            # Chunks without a token, such as that between two blanks.
            chunks = [c for c in chunks if self.ids[c]]
            ids = " ".join(map(self.ids.__getitem__, chunks))
        out = (
            ids.count(" ") + 1 if ids else 0,
            ids,
            " ".join(map(self.labels.__getitem__, chunks)),
        )
        if len(self.ids) > CACHE_CHUNKS or len(self.words) > CACHE_CHUNKS:
            self.ids, self.labels, self.words = {}, {}, {}
        return out


def encode_documents(docs: DataFrame, tokenizer_path: str | None = None, ids: bool = False, decoded: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``.

    ``ids`` and ``decoded`` ask for these themselves as well.  ``tokenizer_path`` is read where
    the tasks run; by default the 49k word vocabulary of the installed public tokenizers.
    A null or blank text has no tokens and decodes to the empty text; repeated rows and null
    ids each keep their row; further columns are ignored; texts of any length are coded whole.
    """
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    fields += ", ids array<int>" * ids + ", decoded string" * decoded

    def run(batches):
        path = tokenizer_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        coder = WordCoder(path)
        for batch in batches:
            done, rows, held = 0, [], 0

            def out():
                n, id_sums, text_sums, lists, texts = zip(*rows)
                columns = [batch.column(0).slice(done, len(rows)), pa.array(n, pa.int64()), pa.array(id_sums, pa.string()), pa.array(text_sums, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                if decoded:
                    columns.append(pa.array(texts, pa.string()))
                    names.append("decoded")
                return pa.RecordBatch.from_arrays(columns, names)

            for value in batch.column(1):
                count, joined, labels = coder.code(value.as_py())
                rows.append(
                    (
                        count,
                        hashlib.sha256(joined.encode()).hexdigest(),
                        hashlib.sha256(labels.encode()).hexdigest(),
                        np.fromstring(joined, np.int32, sep=" ") if ids else None,
                        labels if decoded else None,
                    )
                )
                held += count
                if held >= SLICE_TOKENS:
                    yield out()
                    done, rows, held = done + len(rows), [], 0
            if rows:
                yield out()

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(run, fields)
