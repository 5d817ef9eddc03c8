"""Token ids of a word-level vocabulary in the file format of ``tokenizers``, its path a parameter."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from functools import lru_cache
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from huntlake.llm.recompression import ranges

VOCABULARY = "word_bpe_49k.json"
#: Words after which a new filling of kept ids begins (some 200 bytes a word), and the bytes of the longest word kept.
KEPT_WORDS, KEPT_BYTES = 1 << 19, 32
# Fixed value: the rule by which vocabularies of this kind cut words.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters and marks whose treatment does not depend on their neighbours: each word of them is cut as marks, letters, marks.
LETTER, MARK = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
PLAIN = re.compile(f"([{MARK}]*)([{LETTER}]*)([{MARK}]*)")


class WordIds:
    """Ids of texts, each word looked up once: the ids of a text are those of its words, one after the other.

    Words are what lies between white space of one byte. The vocabulary drops
    white space, and none of its rules reaches across it. Plain words go to the
    model of the vocabulary directly, others through all of its rules.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.known = Tokenizer.from_file(path)
        self.known.encode_special_tokens = True  # their names in a text are ordinary text
        rules = json.loads(self.known.to_str())
        if rules["post_processor"] or WORD_RULE not in json.dumps(rules["pre_tokenizer"]).encode().decode("unicode_escape"):
            raise ValueError(f"{path} does not cut words by {WORD_RULE}")
        rewritten = {}
        for code in range(256):
            if PLAIN.fullmatch(chr(code)):
                ((written, _),) = self.known.pre_tokenizer.pre_tokenize_str(self.known.normalizer.normalize_str(chr(code)))
                rewritten[code] = written
        self.rewritten = rewritten
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _look_up(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        found, odd, texts = {}, [], []
        for word in words:
            text = word.decode()
            plain = PLAIN.fullmatch(text)
            if plain:
                ids = [token.id for part in plain.groups() if part for token in self.known.model.tokenize(part.translate(self.rewritten))]
                found[word] = pack(f"<{len(ids)}I", *ids)
            else:
                odd.append(word)
                texts.append(text)
        for word, one in zip(odd, self.known.encode_batch_fast(texts, add_special_tokens=False)):
            found[word] = pack(f"<{len(one)}I", *one.ids)
        return found

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and where each text's begin and the last one's end; none for NULL."""
        words = pc.ascii_split_whitespace(texts.fill_null(""))
        found = words.flatten().dictionary_encode()
        known = self._known(found.dictionary.cast(pa.binary()).to_pylist())
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        which = found.indices.to_numpy()
        counts = sizes[which]
        ids = np.frombuffer(b"".join(known), "<u4")[ranges(starts[which], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])
        return ids, ends[bounds]

    def _known(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words. Those not seen for two fillings of ``kept`` are forgotten, so frequent ones stay."""
        if len(self.kept) > KEPT_WORDS:
            self.older, self.kept = self.kept, {}
        new = [word for word in words if word not in self.kept]
        self.kept.update((word, self.older[word]) for word in new if word in self.older)
        new = [word for word in new if word not in self.older]
        self.kept.update(self._look_up(new))
        found = [self.kept[word] for word in words]
        for word in new:
            if len(word) > KEPT_BYTES:
                del self.kept[word]
        return found


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """The ids of a vocabulary, one for each process, so that tasks of a worker share what it has looked up."""
    return WordIds(path)


def ids_of(texts: pa.Array, path: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    return word_ids(path or public_tokenizers.path(VOCABULARY)).of(texts)
