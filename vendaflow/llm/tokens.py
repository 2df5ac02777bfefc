"""Token ids of a byte-level BPE vocabulary file, exactly as the `tokenizers` library gives them, in bounded memory.

`tokenizers` is the reference. Where the same vocabulary is at hand as ranks, texts made of printable ASCII and Latin
letters alone, without the special string, go to the faster encoder of those ranks: both split such texts by the same
pattern and merge by the same ranks, which the tests compare. Every other text goes to `tokenizers` itself.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from functools import lru_cache

import numpy as np

_PLAIN = re.compile(r"[\t\n\r -~¡-¬®-ɏ]*")
_CUT = re.compile(r"[A-Za-z](?= [A-Za-z])")
_CHUNK = 1 << 16


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def file_digest(path: str) -> str:
    """Version of a tokenizer: digest of its file."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


@lru_cache(maxsize=4)
def _encoders(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(path)
    ranks_path = re.sub(r"\.json$", ".tiktoken", path)
    fast = None
    if ranks_path != path and os.path.exists(ranks_path):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        if all(exact.id_to_token(i) is not None for i in ranks.values()):
            fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={})
    specials = [t.content for t in exact.get_added_tokens_decoder().values()]
    return exact, fast, specials


def _chunks(text: str):
    """Parts whose tokens, laid end to end, are those of the whole: cuts stand before a space between two letters,
    where the vocabulary's pattern always ends a token."""
    at = 0
    while len(text) - at > _CHUNK:
        cut = _CUT.search(text, at + _CHUNK)
        if cut is None:
            break
        yield text[at:cut.end()]
        at = cut.end()
    yield text[at:] if at else text


def encode(text: str, path: str) -> np.ndarray:
    """Ids of a whole text, without added special tokens, cutting or padding."""
    exact, fast, specials = _encoders(path)
    out = []
    for part in _chunks(text):
        if fast is not None and _PLAIN.fullmatch(part) and not any(s in part for s in specials):
            out.append(np.asarray(fast.encode_ordinary(part), np.uint32))
        else:
            out.append(np.asarray(exact.encode(part, add_special_tokens=False).ids, np.uint32))
    return out[0] if len(out) == 1 else np.concatenate(out)
