"""Token ids of whole texts with the public byte-pair tokenizers.

The tokenizer files are read once per Python process. Their merges are applied by a native merger that takes the same
tokens as ranked byte strings; the files are checked for the form that this relies on. What the written-out rules do
not cover goes through the tokenizer as it is.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Sequence

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# How the byte-level tokenizer cuts a text into pre-tokens.
BYTES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# How the word tokenizer cuts lower-case text, restricted to the characters of SIMPLE.
LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
DIGIT = "0-9²³¹¼-¾"
WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTER}]+|[{DIGIT}]|[^\s{LETTER}{DIGIT}]+")
SIMPLE = re.compile("[\t\n\r -~¡-įı-ɏ]*")  # without the capital I with a dot, whose lower case is two characters
BLANKS = re.compile(r"[\t\n\r ]+")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letters that stand for the 256 bytes: visible ones for themselves, the others in turn from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def tokens_of(path: str) -> tuple[dict, dict[str, int], list[str]]:
    """The file, its tokens with their ids, and the special tokens. Merges must be in the order of the ids."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    if model["type"] != "BPE" or model.get("ignore_merges") or model.get("byte_fallback") or model.get("unk_token"):
        raise ValueError(f"{path}: not a byte-pair model with merges for all bytes")
    vocab = model["vocab"]
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        raise ValueError(f"{path}: ids are not in the order of the merges")
    return content, vocab, [t["content"] for t in content["added_tokens"]]


class ByteBpe:
    """A byte-level tokenizer, white space included. ``spelled`` holds the bytes of each id."""

    def __init__(self, path: str):
        import tiktoken

        content, vocab, special = tokens_of(path)
        before, added = content["pre_tokenizer"], {t["content"]: t["id"] for t in content["added_tokens"]}
        if content["normalizer"] or before["type"] != "ByteLevel" or not before["use_regex"] or before["add_prefix_space"]:
            raise ValueError(f"{path}: not a byte-level tokenizer without normalizer")
        letters = byte_letters()
        ranks = {bytes([letters[c] for c in token]): i for token, i in vocab.items() if token not in special}
        self.size = max([*vocab.values(), *added.values()]) + 1
        self.spelled = [b""] * self.size
        for token, i in (*ranks.items(), *((s.encode(), i) for s, i in added.items())):
            self.spelled[i] = token
        self.merger = tiktoken.Encoding(path, pat_str=BYTES, mergeable_ranks=ranks, special_tokens=added)
        self.lengths = np.array([len(s) for s in self.spelled])
        # What the file says of these changes the ids or offsets that the library gives for a text.
        self.plain = not any(content.get(k) for k in ("post_processor", "truncation", "padding"))

    def encode(self, texts: Sequence[str | None], plain: bool = False) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers; null is empty. ``plain``: a special token's string is text."""
        allowed = set() if plain else "all"
        return [self.merger.encode_to_numpy(t or "", allowed_special=allowed, disallowed_special=()) for t in texts]


class WordBpe:
    """A tokenizer of lower-case words whose last character is marked; white space is dropped.

    To the merger a word's end is a zero byte. Merging it with the byte before comes first, as those tokens have the
    lowest ids after the bytes, so the result is that of the marked characters.
    """

    END = "</w>"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        content, vocab, special = tokens_of(path)
        letters = byte_letters()
        if content["model"]["end_of_word_suffix"] != self.END or any(vocab[c] >= 256 or not 256 <= vocab[c + self.END] < 512 for c in letters):
            raise ValueError(f"{path}: not a tokenizer of words with marked ends")
        ranks = {}
        for token, i in vocab.items():
            if token not in special:
                ended = token.endswith(self.END)
                ranks[bytes([letters[c] for c in token.removesuffix(self.END)]) + b"\0" * ended] = i
        self.size = max(vocab.values()) + 1
        self.tokenizer = Tokenizer.from_file(path)
        self.merger = tiktoken.Encoding(path, pat_str="[^\\x00]+\\x00", mergeable_ranks=ranks, special_tokens={})

    def _simple(self, text: str) -> np.ndarray:
        words = WORDS.findall(text.lower())
        return self.merger.encode_to_numpy("\0".join([*words, ""]), disallowed_special=())

    def _encode(self, text: str) -> np.ndarray:
        if SIMPLE.fullmatch(text) and "<|" not in text:
            return self._simple(text)
        parts, together = [np.zeros(0, np.uint32)], []
        for chunk in BLANKS.split(text):
            if SIMPLE.fullmatch(chunk) and "<|" not in chunk:
                together.append(chunk)
                continue
            parts.append(self._simple(" ".join(together)))
            together = []
            parts.append(np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, np.uint32))
        return np.concatenate([*parts, self._simple(" ".join(together))])

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit integers; null is empty."""
        return [self._encode(t or "") for t in texts]


def offsets_of(text: str, lengths: np.ndarray) -> np.ndarray:
    """Start and end character of tokens that are ``lengths`` bytes long each; a part of a character counts as all of it."""
    end = np.cumsum(lengths)
    start = end - lengths
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data) != len(text):
        place = np.cumsum((data & 0xC0) != 0x80)
        start, end = place[start] - 1, place[end - 1]
    return np.stack([start, end], axis=1).astype(np.int32)


def encoder_with_offsets(path: str) -> Callable[[str], tuple[np.ndarray, np.ndarray]]:
    """A function that gives a text's ids and offsets. A file that is not byte-level is read by the library."""
    try:
        fast = encoder(path)
    except (KeyError, TypeError, ValueError):
        fast = None
    if isinstance(fast, ByteBpe) and fast.plain:

        def encode(text: str) -> tuple[np.ndarray, np.ndarray]:
            ids = fast.encode([text])[0]
            return ids, offsets_of(text, fast.lengths[ids])

        return encode

    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)

    def encode_as_it_is(text: str) -> tuple[np.ndarray, np.ndarray]:
        encoded = whole.encode(text, add_special_tokens=False)
        return np.array(encoded.ids, np.int64), np.array(encoded.offsets, np.int32).reshape(-1, 2)

    return encode_as_it_is


_ENCODERS: dict[str, ByteBpe | WordBpe] = {}


def encoder(path: str) -> ByteBpe | WordBpe:
    """The encoder for a tokenizer file, kept in this Python process. A file of neither kind is an error."""
    if path not in _ENCODERS:
        with open(path, encoding="utf-8") as file:
            marked = json.load(file)["model"].get("end_of_word_suffix")
        _ENCODERS[path] = WordBpe(path) if marked else ByteBpe(path)
    return _ENCODERS[path]
