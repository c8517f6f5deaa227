"""Public tokenizer files (``tokenizer.json``) of byte-level BPE: read into a codec, and written.

A file is as large as its vocabulary, so it is one row, read and written by Spark wherever it lies. What
the jobs here cannot do exactly (another model, dropout, other normalizers or splits than the byte-level
ones) is refused, not approximated.
"""

from __future__ import annotations

import json
import re
from typing import Any

from pyspark.sql import SparkSession

from textloom.functions.pretokens import PRETOKEN
from textloom.functions.tokens import Codec
from textloom.operators.vocabulary import Vocabulary
from textloom.sources.sinks import _mode


class Unsupported(ValueError):
    """The file asks for something that the codec does not do."""


def _expect(holds: bool, what: str) -> None:
    if not holds:
        raise Unsupported(what)


def _split_pattern(pre: dict[str, Any] | None) -> str:
    """The pattern of the pre-tokens: that of the byte-level splitter, or one split before it."""
    _expect(pre is not None, "no pre-tokenizer")
    parts = pre["pretokenizers"] if pre["type"] == "Sequence" else [pre]
    last = parts[-1]
    _expect(last["type"] == "ByteLevel" and not last.get("add_prefix_space"), f"pre-tokenizer {last}")
    if len(parts) == 1:
        _expect(last.get("use_regex", True), "a byte-level pre-tokenizer that does not split")
        return PRETOKEN
    _expect(len(parts) == 2 and not last.get("use_regex", True), f"pre-tokenizers {[p['type'] for p in parts]}")
    split = parts[0]
    _expect(
        split["type"] == "Split"
        and "Regex" in split["pattern"]
        and split["behavior"] in ("Isolated", "Removed")
        and split.get("invert", False) == (split["behavior"] == "Removed"),
        f"split {split}",
    )
    # Classes of characters are Unicode classes there.
    return "(?U)" + split["pattern"]["Regex"]


def _normalizes(normalizer: dict[str, Any] | None) -> bool:
    _expect(normalizer is None or normalizer == {"type": "NFKC"}, f"normalizer {normalizer}")
    return normalizer is not None


def read_tokenizer(spark: SparkSession, path: str) -> Codec:
    """A codec with the vocabulary, merges, special tokens, split and normalizer of a tokenizer file."""
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).limit(2).collect())
    info = json.loads(text)
    model = info["model"]
    _expect(model.get("type", "BPE") == "BPE", f"model {model.get('type')}")
    for name in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"):
        _expect(not model.get(name), f"{name} = {model.get(name)}")
    ids = dict(model["vocab"])
    added = info.get("added_tokens") or []
    for token in added:
        plain = not (token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"])
        _expect(plain, f"added token {token}")
        # A pre-token that equals an added token could not be told from it.
        _expect(not re.fullmatch(r"\s*(\w+|[^\w\s]+)", token["content"]), f"added token {token['content']!r}")
        ids[token["content"]] = token["id"]
    _expect(sorted(ids.values()) == list(range(len(ids))), "ids with gaps or repeats")
    ranks = {}
    for rank, merge in enumerate(model["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        ranks.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
    return Codec(
        tokens=sorted(ids, key=ids.__getitem__),
        ranks=ranks,
        specials=tuple(t["content"] for t in added),
        spark=spark,
        special_ids=tuple(t["id"] for t in added),
        normalize=_normalizes(info.get("normalizer")),
        pattern=_split_pattern(info.get("pre_tokenizer")),
    )


def tokenizer_json(vocabulary: Vocabulary) -> str:
    """A learned vocabulary as a tokenizer file."""
    specials = vocabulary.tokens[: vocabulary.n_special]
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    pairs = [[vocabulary.tokens[s] for s in merge] for merge in vocabulary.merge_ids()]
    model = {
        "type": "BPE",
        "dropout": None,
        "unk_token": None,
        "continuing_subword_prefix": None,
        "end_of_word_suffix": None,
        "fuse_unk": False,
        "byte_fallback": False,
        "ignore_merges": False,
        "vocab": {t: i for i, t in enumerate(vocabulary.tokens)},
        "merges": pairs,
    }
    info = {
        "version": "1.0",
        "truncation": None,
        "padding": None,
        "added_tokens": [{"id": i, "content": t, **flags} for i, t in enumerate(specials)],
        "normalizer": {"type": "NFKC"},
        "pre_tokenizer": level,
        "post_processor": None,
        "decoder": level,
        "model": model,
    }
    return json.dumps(info, ensure_ascii=False)


def write_tokenizer(vocabulary: Vocabulary, spark: SparkSession, path: str, replace: bool = True) -> None:
    """The tokenizer file of a learned vocabulary, as the only part of the folder ``path``."""
    rows = spark.createDataFrame([(tokenizer_json(vocabulary),)], "value string")
    rows.coalesce(1).write.mode(_mode(replace)).text(path)
