"""Loading public tokenizers inside tasks.  Files are passed by path, never copied."""

from __future__ import annotations

import functools
import json

import numpy as np

#: Texts longer than this, and those tiktoken refuses, go to ``tokenizers``.
TIKTOKEN_CHARS = 200_000

#: Fixed value: the public pre-tokenisation pattern of byte-level BPE.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                      r"|\s+(?!\S)|\s+")


@functools.lru_cache(maxsize=4)
def hf_tokenizer(path: str):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _byte_of_char() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable
    Latin-1 stands for itself, the other bytes follow from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.lru_cache(maxsize=4)
def byte_bpe(path: str):
    """The byte-level BPE of a ``tokenizers`` file as a tiktoken encoding (the same
    ids, several times as fast), or None where the file is of another kind."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if (spec["model"]["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space") or not pre.get("use_regex", True)
            or spec["model"].get("ignore_merges")):
        return None
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    at = _byte_of_char()
    ranks = {bytes(at[c] for c in token): i for token, i in spec["model"]["vocab"].items()
             if token not in special}
    return tiktoken.Encoding(path, pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks,
                             special_tokens=special)


def encode_ids(path: str, text: str) -> np.ndarray:
    """Ids as ``tokenizers`` gives them with ``add_special_tokens=False``."""
    fast = byte_bpe(path)
    if fast is not None and len(text) <= TIKTOKEN_CHARS:
        try:
            return fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)
        except Exception as e:  # noqa: BLE001  the pattern engine's stack is bounded
            if "stack" not in str(e).lower() and "backtrack" not in str(e).lower():
                raise
    return np.array(hf_tokenizer(path).encode(text, add_special_tokens=False).ids, "<u4")


def is_word_local(spec: dict) -> bool:
    """Whether the normaliser maps white space runs to one space and lower-cases, and
    the pre-tokeniser drops all between words: then white space, and ASCII case,
    outside special strings do not change a text's tokens."""
    norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    pres = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    first = pres[0] if pres else {}
    return (spec["model"]["type"] == "BPE" and norm == ["NFC", "Replace", "Lowercase"]
            and spec["normalizer"]["normalizers"][1].get("pattern") == {"Regex": r"\s+"}
            and spec["normalizer"]["normalizers"][1].get("content") == " "
            and first.get("type") == "Split" and first.get("behavior") == "Removed"
            and first.get("invert") is True
            and all(p["type"] == "ByteLevel" and not p["use_regex"] and not p["add_prefix_space"]
                    for p in pres[1:])
            and spec.get("post_processor") is None
            and all(not t["normalized"] for t in spec["added_tokens"]))


class TokenCounter:
    """Token counts of whole texts as the library gives them, without begin, end or
    added special tokens.  ``path``: ``.json`` for tokenizers, ``.model`` for
    sentencepiece.

    Where words are tokenised one by one (``is_word_local``), the words of plain
    Latin-1 texts are counted once and remembered, at most ``REMEMBER`` of them
    at a time; all other texts go to the library whole.
    """

    REMEMBER = 500_000
    CHARS = 1_000_000  # texts are handed on in groups of about so many characters

    def __init__(self, path: str):
        self.memo: dict[str, int] = {}
        self.split = None
        if path.endswith(".model"):
            import sentencepiece

            self.sp, self.hf = sentencepiece.SentencePieceProcessor(model_file=path), None
            return
        import regex

        self.hf = hf_tokenizer(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if is_word_local(spec):
            self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
            self.marks = [t["content"][:2] for t in spec["added_tokens"]]
            # no control characters, no soft hyphen: every engine reads these alike
            self.plain = regex.compile(r"[\t\n\r\x20-\x7e\xa1-\xac\xae-\xff]*+")

    def __call__(self, texts: list[str]) -> list[int]:
        out: list[int] = []
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (size < self.CHARS or end == at):
                size += len(texts[end])
                end += 1
            out += self._count(texts[at:end])
            at = end
        return out

    def _count(self, texts: list[str]) -> list[int]:
        if self.hf is None:
            return [len(ids) for ids in self.sp.encode(texts, num_threads=1)]
        if self.split is None:
            return self._whole(texts)
        out, words, rest = [0] * len(texts), {}, []
        for i, t in enumerate(texts):
            if self.plain.fullmatch(t) and not any(m in t for m in self.marks):
                words[i] = self.split.findall(t.lower())
            else:
                rest.append(i)
        new = set().union(*words.values()).difference(self.memo)
        if len(self.memo) + len(new) > self.REMEMBER:
            self.memo.clear()
            new = set().union(*words.values())
        new = list(new)
        self.memo.update(zip(new, self._whole(new)))
        for i, w in words.items():
            out[i] = sum(map(self.memo.__getitem__, w))
        for i, n in zip(rest, self._whole([texts[i] for i in rest])):
            out[i] = n
        return out

    def _whole(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.hf.encode_batch_fast(texts, add_special_tokens=False)]


@functools.lru_cache(maxsize=2)
def token_counter(path: str) -> TokenCounter:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
    return TokenCounter(path)
