import numpy as np
import pytest

from tallyworks.llm import suffixes


@pytest.mark.parametrize("scale", [1, 1 << 52])
def test_places_are_sorted_by_value_and_then_place(scale):
    rng = np.random.default_rng(5)
    value, place = rng.integers(0, 50, 2_000) * scale, rng.permutation(2_000)
    got, values = suffixes._sorted_places(value, place, 50 * scale, 2_000)
    expected = np.lexsort((place, value))
    assert (got == place[expected]).all() and (values == value[expected]).all()


@pytest.mark.parametrize("letters, parts, longest", [(1, 12, 30), (2, 20, 25), (20, 8, 40)])
def test_repeated_places_are_those_of_brute_force(letters, parts, longest):
    rng = np.random.default_rng(letters)
    text = np.concatenate([
        np.append(rng.integers(97, 97 + letters, rng.integers(1, longest)), 256 + i) for i in range(parts)
    ])
    strings = [tuple(text[i:i + 6].tolist()) for i in range(len(text))]
    expected = [len(s) == 6 and strings.count(s) > 1 for s in strings]
    assert suffixes.repeated_places(text, 6).tolist() == expected
    assert suffixes.suffix_order(text).tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
