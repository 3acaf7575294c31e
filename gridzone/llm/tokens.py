"""Token ids of a byte-level BPE vocabulary, remembered per word.

The pre-tokenizer of such vocabularies never joins a character to a single
space after it (a space opens the next word), a letter to a mark, or a line
break to the characters about it, and merges stay within its words. So the ids of a
text are those of its parts, cut at such places. Parts recur; each is encoded
once by the tokenizer and then remembered, and looked up once for a batch of texts.
Texts with special tokens are encoded whole.
"""

from __future__ import annotations

import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Put where texts are cut; a text that has it itself is cut another way.
SEP = "\x00"
#: Before a single space, in texts that also have wider ones.
CUT = re.compile(r"(?<! )(?= (?! ))")
LETTER, MARK = "A-Za-zÀ-ÖØ-öø-ÿ", "[.,!?;:%$&*#|]"
#: A space and letters alone are one word of the pre-tokenizer, so such words can be encoded in one text.
PLAIN = re.compile(f" [{LETTER}]+")
TOGETHER = 500
#: Remembered parts at most; beyond, memory starts anew. A worker keeps about 170 bytes for each.
REMEMBERED = 250_000


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that begin with a space
        self.opens[[i for token, i in vocabulary.items() if token.startswith("Ġ")]] = True
        self.parts: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(ids := e.ids)}I", *ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words of a space and letters, many to a text: each word begins where an id begins with a space."""
        some = [words[lo : lo + TOGETHER] for lo in range(0, len(words), TOGETHER)]
        out: list[bytes] = []
        for own, e in zip(some, self.tokenizer.encode_batch_fast(["".join(ws) for ws in some], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            starts = (4 * np.flatnonzero(self.opens[ids])).tolist()
            if len(starts) != len(own):
                out += self._plain(own)
            else:
                data = ids.tobytes()
                out += [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]
        return out

    def _learn(self, parts: list[str]) -> None:
        """Remembers parts that are not known yet."""
        plain = list(filter(PLAIN.fullmatch, parts))
        others = list(set(parts).difference(plain))
        self.parts.update(zip(plain, self._together(plain), strict=True))
        self.parts.update(zip(others, self._plain(others), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        out: list = [None] * len(texts)
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = self._plain([text])[0]
            elif "  " in text or SEP in text:
                own = CUT.split(text)
                self._learn(list({p for p in own if p not in self.parts}))
                out[i] = b"".join(map(self.parts.__getitem__, own))
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._by_distinct_parts([texts[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    def _by_distinct_parts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without double spaces: each distinct part is looked up once, the ids of all are gathered by number."""
        if not texts:
            return []
        cut = pc.replace_substring(pa.array(texts, pa.large_string()), " ", SEP + " ")
        cut = pc.replace_substring_regex(cut, f"([{LETTER}])({MARK})", f"\\1{SEP}\\2")
        cut = pc.replace_substring_regex(cut, f"([{LETTER}0-9.,!?;:])\n([{LETTER}0-9])", f"\\1{SEP}\n{SEP}\\2")
        lists = pc.split_pattern(cut, SEP)
        bounds = lists.offsets.to_numpy()
        coded = lists.flatten().dictionary_encode()
        number, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        values = list(map(self.parts.get, words))
        if new := [w for w, ids in zip(words, values) if ids is None]:
            self._learn(new)
            values = list(map(self.parts.__getitem__, words))
        sizes = np.fromiter(map(len, values), dtype=np.int64, count=len(values)) // 4
        starts = np.cumsum(sizes) - sizes
        own = sizes[number]
        upto = np.cumsum(own)
        place = np.arange(upto[-1]) + np.repeat(starts[number] - (upto - own), own)
        ids = np.frombuffer(b"".join(values), dtype="<u4")[place].tobytes()
        ends = (4 * upto[bounds[1:] - 1]).tolist()
        return [ids[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(path)


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
