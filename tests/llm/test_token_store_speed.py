"""What the id coder and the word tokenizer hold and decode for each id."""

import numpy as np
import pyarrow as pa
import pytest

from martwright.llm import id_coder
from martwright.llm.common import text_list


@pytest.mark.parametrize(("kinds", "size"), [(300, 2), (0xFFFF, 2), (0x10000, 4), (90_000, 4)])
def test_contexts_take_as_few_bytes_as_ranks_need(kinds, size):
    assert id_coder._Model(3, kinds).after_two.itemsize == size
    # All kinds once, then runs that orders 1 and 2 predict.
    ids = np.concatenate([np.arange(kinds) * 3, np.tile(np.arange(kinds - 40, kinds) * 3, 50)])
    ids = ids.astype(np.uint32)
    assert (id_coder.decode(id_coder.encode(ids)) == ids).all()


def test_words_are_decoded_at_once():
    words = ["a", "É", "日本", "x.", "\x7f", "a"]
    array = pa.array([w.encode() for w in ["cut", *words]], pa.large_binary()).slice(1)
    assert text_list(array) == words
    assert text_list(array.slice(0, 1)) == ["a"]
    assert text_list(array.slice(0, 0)) == []
