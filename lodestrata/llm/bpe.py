"""Exact encoding with the vocabulary files of public tokenizers.

A byte-level BPE text may be cut before any single space that stands between two
characters that are not white space: the pre-tokenizer binds that space to what
follows and never matches across it. Long texts are cut there, so one call's memory
is bounded by the cut size (a run without such a place stays whole). Nothing is kept
between calls but the ranks. Files of other kinds go to their own library.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_CUT = 1 << 16


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for raw bytes, by their rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def probes(special: list[str]) -> list[str]:
    """Texts on which ranks must agree with the library before they are trusted."""
    spaces = ["", " ", "  ", "\n", "\t", "\r\n", " ", " \n ", "　"]
    out = ["It's 2024's été—naïve 数据 I'LL we've", "a \n \n b   ", "x" * 300, " " * 300 + "y", "١٢٣ ४५६ ⅷ²", "éa‍\U0001f469‍\U0001f4bb", "\0\x01\x7f"]
    out += [f"a{s}b{s}{s}c{s}" for s in spaces]
    out += [f"x{s}{t}{s}y{t}{t}z{t[:-1]}" for t in special for s in spaces]
    rng = np.random.default_rng(5)
    out += [rng.integers(0, 256, 200, np.uint8).tobytes().decode("utf-8", "replace") for _ in range(8)]
    out += ["".join(map(chr, rng.choice([*range(32, 127), *range(0xA0, 0x250), 0x4E00, 0x3042, 0x1F600, 9, 10, 13, 32, 32, 32], 200))) for _ in range(8)]
    return out


class Encoder:
    """Ids and counts of whole texts, as the library of the file gives them."""

    def __init__(self, name: str):
        import public_tokenizers

        self.path, self.fast = public_tokenizers.path(name), None
        if name.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=self.path)
            self.library = lambda texts: model.encode(texts, num_threads=1)
            return
        with open(self.path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] == "BPE" and spec.get("normalizer") is None and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel":
            self.fast = self._ranked(spec)
        if self.fast is not None:
            self.__dict__.pop("library", None)  # loaded again only when asked for: it would hold memory in every worker

    def __getattr__(self, name: str):
        if name != "library":
            raise AttributeError(name)
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.library = lambda texts: [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return self.library

    def slow(self, text: str) -> list[int]:
        """What the library itself gives."""
        return self.library([text])[0]

    def _ranked(self, spec: dict):
        """An encoder over ranks for the same file, kept only if it agrees with the library."""
        import public_tokenizers
        import tiktoken

        pre, model = spec["pre_tokenizer"], spec["model"]
        added = spec.get("added_tokens") or []
        if pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("dropout") or any(a["lstrip"] or a["rstrip"] or a["single_word"] or a["normalized"] or re.search(r"\s", a["content"]) for a in added):
            return None
        alphabet, special = _byte_alphabet(), {a["content"]: a["id"] for a in added}
        ranks = {bytes(alphabet[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        encoding, allowed = tiktoken.Encoding("from-json", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special), set(special)
        core = getattr(encoding, "_core_bpe", None)
        if hasattr(core, "encode_to_tiktoken_buffer"):  # gives bytes, no list of ints

            def encode(text: str) -> np.ndarray:
                return np.frombuffer(core.encode_to_tiktoken_buffer(text, allowed), "<u4")
        else:

            def encode(text: str) -> np.ndarray:
                return np.array(encoding.encode(text, allowed_special=allowed), "<u4")

        tests = probes(list(special))
        if any(encode(t).tolist() != ids for t, ids in zip(tests, self.library(tests), strict=True)):
            return None
        return encode

    @staticmethod
    def pieces(text: str, size: int = _CUT) -> list[str]:
        """The text cut at safe places into pieces of about ``size`` characters."""
        out, at = [], 0
        while len(text) - at > size:
            cut = _SAFE_CUT.search(text, at + size)
            if cut is None:
                break
            out.append(text[at : cut.start()])
            at = cut.start()
        return [*out, text[at:]]

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text as uint32, little-endian."""
        if self.fast is None:
            return [np.array(ids, "<u4") for ids in self.library(texts)]
        return [self._one(t) if len(t) <= _CUT else np.concatenate([self._one(p) for p in self.pieces(t)]) for t in texts]

    def counts(self, texts: list[str]) -> list[int]:
        """The number of ids of each text."""
        if self.fast is None:
            return [len(ids) for ids in self.library(texts)]
        return [len(ids) for ids in self.batch(texts)]

    def _one(self, text: str) -> np.ndarray:
        try:
            return self.fast(text)
        except ValueError:  # the regex engine gives up on very long runs of white space
            return np.array(self.slow(text), "<u4")

    def ids(self, text: str) -> np.ndarray:
        return self.batch([text])[0]

    def count(self, text: str) -> int:
        return self.counts([text])[0]


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """One encoder a worker process and file."""
    return Encoder(name)
