"""Byte-level BPE in Python workers, with the ids the tokenizers library gives.

The tokenizer file is read on the driver and shipped as text, so executors need
no local copy. ``Pretokens`` splits texts as the file's byte-level pre-tokenizer
does. Its regular expressions use the Unicode tables of the installed ``regex``
module, which are newer than the library's; texts with characters outside
``SAME_TABLES`` (ranges on which both agree, see the tests) or with one of the
file's special strings are left to the library as a whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

from fieldwatch.llm.common import worker_store

# fixed values: the pre-token pattern of byte-level BPE, and its ASCII form
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ASCII_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
# ASCII controls 1C-1F are white space for Python's re, not for the library
SAME_TABLES = "\x00-\x1b\x20-\u0557\u2000-\u206f\u20a0-\u20bf\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"


def tokenizer_text(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def special_strings(spec: str) -> list[str]:
    return [t["content"] for t in json.loads(spec).get("added_tokens", [])]


def load_tokenizer(spec: str):
    """The library's tokenizer for a file's text; one per Python worker."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    store = worker_store("tokenizers")
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in store:
        tk = Tokenizer.from_str(spec)
        tk.no_truncation()
        tk.no_padding()
        store[key] = tk
    return store[key]


class Pretokens:
    """``split(text)``: the pre-tokens, or None when the library must do it."""

    def __init__(self, spec: str):
        import regex

        kind = json.loads(spec)
        pre = kind.get("pre_tokenizer") or {}
        self.usable = (kind.get("normalizer") is None and pre.get("type") == "ByteLevel"
                       and not pre.get("add_prefix_space") and pre.get("use_regex", True))
        self.ascii = re.compile(ASCII_PATTERN, re.ASCII).findall
        self.any = regex.compile(PATTERN).findall
        self.odd = re.compile(f"[^{SAME_TABLES}]").search
        specials = special_strings(spec)
        self.special = re.compile("|".join(map(re.escape, specials))).search if specials else lambda _: None

    def split(self, text: str):
        if not self.usable or self.odd(text) or self.special(text):
            return None
        return self.ascii(text) if text.isascii() else self.any(text)


def byte_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level BPE vocabularies: printable Latin-1 bytes
    stand for themselves, the others follow from U+0100 on in byte order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


def ranked_encoder(spec: str):
    """text -> ids (numpy uint32) through tiktoken over the file's own
    vocabulary: for a byte-level BPE whose ids follow the order of its merges, a
    piece's id is its merge rank. None if the file is of another kind."""
    import tiktoken

    store = worker_store("ranked")
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key in store:
        return store[key]
    kind = json.loads(spec)
    model = kind["model"]
    alphabet = byte_alphabet()
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    vocab = model["vocab"]
    in_order = (Pretokens(spec).usable and not model.get("end_of_word_suffix")
                and not model.get("continuing_subword_prefix") and not model.get("ignore_merges")
                and not model.get("dropout")
                and all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)))
    store[key] = None
    if in_order:
        ranks = {bytes(alphabet[c] for c in piece): i for piece, i in vocab.items()}
        store[key] = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return store[key]
