"""Public tokenizer files in worker processes."""

from __future__ import annotations

import json
import os
import re

import numpy as np

from tessera.llm._words import WordCache, chunks

_ready: dict[tuple[str, bool], "FileTokenizer"] = {}


class FileTokenizer:
    """A tokenizer file of the tokenizers library, which adds no special tokens;
    each distinct word goes through the library once per worker.

    Where the string of a special token stands in a text, it is ordinary text, or
    that token (the library's own way) if not ``special_as_text``.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.cache = WordCache(self._encode_words)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [], []
        for at in range(0, len(words), 4096):
            part = words[at:at + 4096]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            ids.append(np.array(found.ids, np.int64))
            sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(part)))
        return np.concatenate(ids), np.concatenate(sizes)

    def encode(self, texts: list[str | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and row offsets; ``end_id`` closes each row."""
        ids, offsets = self.cache.encode([chunks(t) for t in texts])
        if end_id is not None:
            ids = np.insert(ids, offsets[1:], end_id)
            offsets = offsets + np.arange(len(offsets))
        return ids, offsets


def tokenizer(path: str, special_as_text: bool = True) -> FileTokenizer:
    if (path, special_as_text) not in _ready:
        _ready[path, special_as_text] = FileTokenizer(path, special_as_text)
    return _ready[path, special_as_text]


# Fixed value: the pattern by which the tokenizers library's byte-level step cuts texts.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable
    ones for themselves, the others in order from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteLevelTokenizer:
    """A byte-level BPE file of the tokenizers library whose merges go by id: tiktoken
    then merges alike, in a third of the time and without a cache of words (tests compare the two libraries
    on every code point and on whole tables)."""

    def __init__(self, spec: dict, special_as_text: bool = True):
        import tiktoken

        letters = _byte_of_letter()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        self.encoding = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        words = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(words)})") if words and not special_as_text else None

    @staticmethod
    def reads(spec: dict) -> bool:
        """Is the file of this kind?  (No normaliser, the plain byte-level step, merges
        in the order of the ids they make, added tokens that are special and match as they are.)"""
        model, step = spec["model"], spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or (step.get("type"), step.get("add_prefix_space"), step.get("use_regex", True)) != ("ByteLevel", False, True):
            return False
        odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model.get("type", "BPE") != "BPE" or any(model.get(k) for k in odd):
            return False
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        plain = all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"])
        return plain and all(a < b for a, b in zip(made, made[1:]))

    def encode(self, texts: list[str | None], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and row offsets; ``end_id`` closes each row."""
        plain, rows = self.encoding.encode_ordinary, []
        for text in texts:
            if not text:
                ids = []
            elif self.cut and self.cut.search(text):
                parts = self.cut.split(text)  # every other part is a special token
                ids = [i for k, p in enumerate(parts) for i in ([self.special[p]] if k % 2 else plain(p))]
            else:
                ids = plain(text)
            if end_id is not None:
                ids.append(end_id)
            rows.append(np.array(ids, np.int32))
        offsets = np.cumsum([0, *map(len, rows)])
        return np.concatenate(rows) if rows else np.zeros(0, np.int32), offsets


def byte_level(path: str, special_as_text: bool = True) -> "ByteLevelTokenizer | FileTokenizer":
    """The file's tokenizer in this process; files of another kind go through the tokenizers library."""
    key = (f"bytes:{path}", special_as_text)
    if key not in _ready:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        _ready[key] = ByteLevelTokenizer(spec, special_as_text) if ByteLevelTokenizer.reads(spec) else tokenizer(path, special_as_text)
    return _ready[key]
