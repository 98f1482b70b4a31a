import random

import pytest

from riskloom.operators.similarity import Block, _positions, common_length, prepare, weighted_ratio

WORDS = (
    "republic of the islands guyana brazil congo dem rep saint new guinea south sudan north korea federated states "
    "micronesia fed sts a b an co operative"
).split()


def table_length(a, b):
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
    return rows[-1][-1]


def some_name(rng):
    text = list(" ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 5))))
    for _ in range(rng.randint(0, 3)):
        text[rng.randrange(len(text))] = rng.choice("abcdefgh  ")
    return "".join(text).strip() or "x"


def test_common_length_equals_the_table():
    rng = random.Random(1)
    for _ in range(500):
        a, b = some_name(rng), some_name(rng)
        assert common_length(_positions(a), len(a), b) == table_length(a, b)


@pytest.mark.parametrize(
    "a, b, score",
    [
        ("viet nam", "vietnam", 93.33),
        ("turkey", "turkiye", 76.92),
        ("iran  islamic republic of", "iran  islamic rep", 81.43),
        ("iran  islamic republic of", "kyrgyz republic", 85.5),
        ("africa", "central african republic", 90.0),
        ("federated states of micronesia", "micronesia  fed  sts", 85.5),
        ("co operative republic of guyana", "guyana", 90.0),
        ("federative republic of brazil", "brazil", 90.0),
        ("", "brazil", 0.0),
        ("brazil", "brazil", 100.0),
    ],
)
def test_known_scores(a, b, score):
    assert weighted_ratio(prepare(a), prepare(b)) == pytest.approx(score, abs=0.005)


@pytest.mark.parametrize("threshold", [60, 70, 85, 90])
def test_best_two_equal_a_full_scan(threshold):
    rng = random.Random(threshold)
    candidates = sorted({some_name(rng) for _ in range(200)})
    block = Block(candidates)
    for _ in range(60):
        name = some_name(rng)
        scores = [weighted_ratio(prepare(name), c) for c in block.names]
        least, greatest = block.limits(prepare(name))
        assert all(low <= s <= high for low, s, high in zip(least, scores, greatest))
        expected = sorted((-s, i) for i, s in enumerate(scores) if s >= threshold)[:2]
        assert [(-s, i) for s, i in block.best_two(name, threshold)] == expected


def test_a_needed_score_changes_no_result_at_or_above_it():
    rng = random.Random(9)
    for _ in range(400):
        a, b = prepare(some_name(rng)), prepare(some_name(rng))
        score = weighted_ratio(a, b)
        for needed in (score, score - 1, 85.0):
            limited = weighted_ratio(a, b, needed)
            assert limited == score if score >= needed else limited <= score


def test_many_candidates_with_one_common_word():
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    candidates = ["republic of " + "".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(300)]
    candidates += ["".join(rng.choice(letters) for _ in range(5)) + " republic" for _ in range(300)]
    block = Block(candidates)
    for name in ["the very long name of one republic", "republic", "republic of abcdef", "old republic of xyzzy islands"]:
        scores = [weighted_ratio(prepare(name), c) for c in block.names]
        expected = sorted((-s, i) for i, s in enumerate(scores) if s >= 85)[:2]
        assert [(-s, i) for s, i in block.best_two(name, 85)] == expected
