"""Words of a batch of texts as arrays: shared by the text classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from docsmith.llm.common import ship_by_value


def batch_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(owner, distinct, code): for every whitespace-separated word of every
    text, in order, the row it stands in and its place among ``distinct``
    lower-cased words.  Null texts have none."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    owner = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(lists)
    coded = flat.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    filled = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[code] if len(code) else np.zeros(0, bool)
    return owner[filled], coded.dictionary, code[filled]


ship_by_value(__name__)
