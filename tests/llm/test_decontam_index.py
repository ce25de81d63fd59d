import numpy as np

from lodeframe.llm import decontam


def test_equal_lengths_are_embedded_together(monkeypatch):
    """An index embeds once a length and walk, not once an item, and each item has the samples that it has alone."""
    rng, calls, embed = np.random.default_rng(5), [], decontam.embed
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 90, 6 + i % 3)).encode()) for i in range(30)]
    monkeypatch.setattr(decontam, "embed", lambda *args: calls.append(1) or embed(*args))
    index = decontam.Index(items, decontam.RATIO)
    assert len(calls) == 3 * decontam.WALKS
    for one in items:
        own, alone = next(i for i in index.items if i[0] == one[0]), decontam.Index([one], decontam.RATIO).items[0]
        assert [w for w, *_ in own[3]] == [w for w, *_ in alone[3]] and all((a[1] == b[1]).all() and (a[2] == b[2]).all() for a, b in zip(own[3], alone[3]))
