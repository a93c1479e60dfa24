"""Token ids of Arrow text by a public byte-level BPE vocabulary.

The pre-tokenizer always begins a new piece at a space that a visible
character follows, so a text's ids are the ids of the parts between such
spaces. Parts repeat a lot; each distinct one is encoded once per step. Where special
tokens are not taken as text, a text that holds one is encoded as a whole: white space
before it ends a piece.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cohortloom.llm.common import gather, numbered

_KEPT_PARTS = 200_000
_PARTS_TEXT, _PARTS_CALL = 200, 20_000  # parts encoded as one text, and in one call
_SPACE = re.compile(r" (?=\S)")
#: A space before white space or the end, where a plain split at spaces is wrong.
_ODD_SPACE = r" (?:$|[\s\x0B\x1C-\x1F\x{85}\p{Z}])"


class PartEncoder:
    """Encodes texts; keeps the ids of parts that came more than once, up to a bound."""

    def __init__(self, path: str, special_as_text: bool = True):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = special_as_text
        added = self._tokenizer.get_added_tokens_decoder().values()
        self._whole = [t.content for t in added if t.content and not (special_as_text and t.special)]
        self._known: dict[str, bytes] = {}
        # Tokens that begin with a space, which byte-level vocabularies write as this letter.
        vocabulary = self._tokenizer.get_vocab()
        self._spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self._spaced[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True

    def _ids(self, strings: list[str]) -> list[bytes]:
        encoded = self._tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids (uint32) of all texts end to end, and len + 1 offsets. Null: no ids."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        whole = pa.array(np.zeros(len(texts), bool))
        for token in self._whole:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        if pc.any(pc.or_(odd, whole)).as_py():
            split = [[t] if w else _SPACE.split(t) for t, w in zip(texts.to_pylist(), whole.to_pylist())]
            parts = pa.array(split, pa.list_(pa.string()))
        else:
            parts = pc.split_pattern(texts, " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        flat = parts.flatten()
        first = np.zeros(len(flat), bool)
        first[offsets[:-1]] = True
        distinct, index = numbered(flat)
        spaced = self._with_space(distinct.to_pylist(), index)
        pieces = spaced + self._ids(flat.filter(pa.array(first)).to_pylist())
        # The first part of a text has no space before it: an entry of its own.
        index[first] = len(spaced) + np.arange(len(texts))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        starts = np.cumsum(lengths) - lengths
        pool = np.frombuffer(b"".join(pieces), np.uint32)
        per_part = lengths[index]
        ids = pool[gather(starts[index], per_part)]
        ends = np.concatenate([[0], np.cumsum(per_part)])
        return ids, ends[offsets]

    def _ids_after_space(self, parts: list[str]) -> list[bytes]:
        """As ``_ids`` of each part with a space before it, but many to a text: where a
        part has no other space, its first token alone begins with one."""
        found: list[bytes] = [b""] * len(parts)
        plain = [i for i, p in enumerate(parts) if " " not in p]
        for i in set(range(len(parts))).difference(plain):
            found[i] = self._ids([" " + parts[i]])[0]
        for many in (plain[i : i + _PARTS_CALL] for i in range(0, len(plain), _PARTS_CALL)):
            texts = [
                "".join(" " + parts[i] for i in many[j : j + _PARTS_TEXT])
                for j in range(0, len(many), _PARTS_TEXT)
            ]
            raw = b"".join(self._ids(texts))
            starts = 4 * np.flatnonzero(self._spaced[np.frombuffer(raw, np.uint32)])
            for i, a, b in zip(many, starts.tolist(), [*starts[1:].tolist(), len(raw)], strict=True):
                found[i] = raw[a:b]
        return found

    def _with_space(self, parts: list[str], index: np.ndarray) -> list[bytes]:
        found = [self._known.get(p) for p in parts]
        missing = [i for i, f in enumerate(found) if f is None]
        counts = np.bincount(index, minlength=len(parts))
        for i, ids in zip(missing, self._ids_after_space([parts[i] for i in missing])):
            found[i] = ids
            if counts[i] > 1 and len(self._known) < _KEPT_PARTS:
                self._known[parts[i]] = ids
        return found
