"""What a worker keeps after a task."""

import numpy as np

from lawloom.llm import common, packing


def test_workers_keep_no_powers():
    common.span_hashes(np.zeros(1 << 20, np.uint8), np.array([0]), np.array([9]))
    assert common._POWERS
    common.give_back()
    assert not common._POWERS


def test_rules_of_the_tokenizer_are_read_without_its_vocabulary(monkeypatch):
    read = []
    loads = packing.json.loads
    monkeypatch.setattr(packing.json, "loads", lambda x: read.append(len(x)) or loads(x))
    assert packing.Words(packing.default_tokenizer()).by_words
    assert max(read) < 10_000
