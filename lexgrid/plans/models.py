"""Deterministic stand-in models for the registered queries and tests.

No model weights ship with the library: scoring takes any user callable. The
queries use these small callables because each has an exact SQL twin, so the
scoring path (Arrow batches through ``predict_batch_udf``) can be checked
end to end. Each factory is called once per Python worker.
"""

from __future__ import annotations

import numpy as np

# Class names of the 3-way sentiment task (negative, neutral, positive).
SENTIMENT_LABELS = {0: "negative", 1: "neutral", 2: "positive"}

# Moduli of the length model: logits = [len % 7, len % 5, len % 3].
LENGTH_MODULI = (7, 5, 3)


def length_logits():
    """Class logits from the text length (code points)."""
    moduli = np.array(LENGTH_MODULI, dtype=np.int64)

    def predict(texts: np.ndarray) -> np.ndarray:
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        return (lengths[:, None] % moduli[None, :]).astype(np.float64)

    return predict


ANSWER_MARKER = "shop_brand="


def brand_echo():
    """A 'generator' that answers with the shop_brand field of the rendered prompt."""

    def predict(prompts: np.ndarray) -> np.ndarray:
        out = []
        for p in prompts:
            start = p.find(ANSWER_MARKER)
            if start < 0:
                out.append("")
                continue
            start += len(ANSWER_MARKER)
            end = p.find(";", start)
            out.append(p[start:end if end >= 0 else len(p)].strip())
        return np.array(out, dtype=object)

    return predict


def length_tokenizer():
    """A deterministic tokenizer: each token's id is its length in characters."""
    import re
    token = re.compile("[^ \\n\\t\\r]+")
    return lambda texts: [[len(t) for t in token.findall(x)] for x in texts]
