"""Statistics of whole document texts, computed by slices of Arrow batches; the inputs of the two quality models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from ledgerlake.llm.text import Tokens, raw

#: Features of the quality models with the direction in which quality may move: -1 falls, 0 free.
FEATURES = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbol_share": -1,
    "repeat_share": -1,
    "dup_line_share": -1,
    "upper_share": -1,
    "mark_share": -1,
    "digit_share": 0,
    "non_ascii_share": 0,
    "distinct_share": 0,
    "top_word_share": -1,
    "line_words": 0,
    "odd_end_share": -1,
    "lone_sign_share": -1,
}
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SPACE = np.zeros(256)
_SPACE[[9, 10, 11, 12, 13, 32]] = 1
_CLASSES = np.zeros((256, 7))
_CLASSES[:, 0] = [not 0x80 <= i < 0xC0 for i in range(256)]  # first bytes of code points
_CLASSES[:, 1] = _SPACE
_CLASSES[[ord(c) for c in "#*$%&|<>"], 2] = 1
_CLASSES[65:91, 3] = 1
_CLASSES[97:123, 4] = 1
_CLASSES[48:58, 5] = 1
_CLASSES[[ord(c) for c in "!?"], 6] = 1
_ODD = np.array([32 < i < 127 and not chr(i).isalnum() and chr(i) not in ".,;:" for i in range(256)])


def repeated_words(ids: np.ndarray, n_vocab: int) -> int:
    """Words that lie in a 3-word window found twice or more among `ids`."""
    if len(ids) < 4:
        return 0
    key = ids[:-1] * n_vocab + ids[1:]
    if n_vocab >= 1 << 21:
        key = np.unique(key, return_inverse=True)[1]
    _, which, times = np.unique(key[:-1] * n_vocab + ids[2:], return_inverse=True, return_counts=True)
    twice = times[which] > 1
    inside = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        inside[shift : len(ids) - 2 + shift] |= twice
    return int(inside.sum())


def document_stats(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """COUNTS as longs and FEATURES as doubles, a row for each text. An empty text has zeros in both."""
    tokens = Tokens(texts)
    counts, feats = np.zeros((len(texts), len(COUNTS)), np.int64), np.zeros((len(texts), len(FEATURES)))
    # per word of the slice's vocabulary: ends in a sign other than . , ; or : and is such a sign alone
    words = list(tokens.vocab)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    odd = _ODD[np.frombuffer(b"".join(words), np.uint8)[np.cumsum(sizes) - 1]] if words else np.zeros(0, bool)
    lone = odd & (sizes == 1)
    for i, text in enumerate(texts):
        ids = tokens.ids[tokens.offs[i] : tokens.offs[i + 1]]
        n = len(ids)
        if not n:
            counts[i, 2] = sum(text.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))
            continue
        chars, spaces, symbols, upper, lower, digits, marks = (
            int(x) for x in np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES
        )
        lines = [x for x in text.split(b"\n") if x.strip()]
        dup_lines = len(lines) - len(set(lines))
        repeats, used = repeated_words(ids, len(words)), np.unique(ids, return_counts=True)[1]
        in_words = chars - spaces
        counts[i] = n, in_words, symbols, dup_lines, repeats
        feats[i] = (
            np.log1p(n), in_words / n, symbols / in_words, repeats / n, dup_lines / len(lines), upper / max(1, upper + lower),
            marks / in_words, digits / in_words, (in_words - upper - lower - digits) / in_words, len(used) / n, used.max() / n,
            n / len(lines), odd[ids].mean(), lone[ids].mean(),
        )
    return counts, feats


def stat_columns(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """All columns of both kinds by name, for a slice with a `text` column."""
    counts, feats = document_stats(raw(batch))
    yield from ((name, pa.array(counts[:, k])) for k, name in enumerate(COUNTS))
    yield from ((name, pa.array(feats[:, k])) for k, name in enumerate(FEATURES))
