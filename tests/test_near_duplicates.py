import random

import pytest

from hearthline.operators import near_duplicates
from hearthline.operators.near_duplicates import candidate_pairs, drop_near_duplicates
from tests.test_similarity import plain_score

AT = "2024-01-01T10:00:00Z"
WM = "Washing machine"


def kept(rows, **options):
    return sorted(r._pos for r in drop_near_duplicates(rows, **options).collect())


def key(status, fold=True):
    text = "".join(c if c.isalnum() or c == "_" else " " for c in status.lower()) if fold else status
    return " ".join(sorted(text.split()))


def expected(rows, threshold=90, fold=True, match_timestamp=True):
    """Every row against every earlier row of its block."""
    keep = []
    for j, (device, ts, kind, status) in enumerate(rows):
        block = (device, kind, ts) if match_timestamp else (device, kind)
        earlier = [
            r for r in rows[:j] if ((r[0], r[2], r[1]) if match_timestamp else (r[0], r[2])) == block
        ]
        if not any(plain_score(key(r[3], fold), key(status, fold)) >= threshold for r in earlier):
            keep.append(j)
    return keep


@pytest.mark.parametrize(
    "second, survivors",
    [
        (("d1", AT, WM, "program start"), [0]),
        (("d1", AT, WM, "Start   Program!"), [0]),
        (("d1", AT, WM, "Program Starts"), [0]),
        (("d1", AT, WM, "XXXXXXXXXXXXXXXXXXX"), [0, 1]),
        (("d2", AT, WM, "Program Start"), [0, 1]),
        (("d1", AT, "Dishwasher", "program start"), [0, 1]),
        (("d1", "2024-01-01T11:00:00Z", WM, "Program Start"), [0, 1]),
    ],
)
def test_pairs(bronze, second, survivors):
    assert kept(bronze(("d1", AT, WM, "Program Start"), second)) == survivors


def test_without_time_the_device_is_the_block(bronze):
    rows = bronze(("d1", AT, WM, "Program Failure"), ("d1", "2024-01-02T10:00:00Z", WM, "Program Failure"))
    assert kept(rows) == [0, 1]
    assert kept(rows, match_timestamp=False) == [0]


def test_letter_case_counts_when_asked(bronze):
    rows = bronze(("d1", AT, WM, "program start"), ("d1", AT, WM, "Program Start"))
    assert kept(rows) == [0]
    assert kept(rows, case_insensitive=False) == [0, 1]


def test_dropped_rows_still_drop_later_ones(bronze):
    # 1 is similar to 0 and 2 to 1, but 2 is not similar to 0
    chain = ["abcdefghijkl", "abcdefghijklm", "abcdefghijklmn"]
    rows = [("d1", AT, WM, s) for s in chain]
    assert plain_score(chain[0], chain[2]) >= 90
    longer = ["aaaaaaaaaa", "aaaaaaaaaab", "aaaaaaaaaabb", "aaaaaaaaabbb"]
    rows += [("d2", AT, WM, s) for s in longer]
    assert plain_score(longer[0], longer[3]) < 90 <= plain_score(longer[2], longer[3])
    assert kept(bronze(*rows)) == expected(rows) == [0, 3]


def test_one_row_and_no_rows(bronze):
    rows = bronze(("d1", AT, WM, "Program End"))
    assert kept(rows) == [0]
    assert kept(rows.limit(0)) == []


def random_events(seed, n, devices, times, words):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        status = " ".join(rnd.choices(words, k=rnd.randint(1, 3)))
        if rnd.random() < 0.5:
            spot = rnd.randint(0, len(status))
            status = status[:spot] + rnd.choice(["x", "", "Q", "!"]) + status[spot + rnd.randint(0, 1):]
        rows.append((f"d{rnd.randrange(devices)}", f"2024-01-01T10:00:0{rnd.randrange(times)}Z", WM, status or "-"))
    return rows


@pytest.mark.parametrize("fold", [True, False])
@pytest.mark.parametrize("match_timestamp", [True, False])
def test_matches_brute_force(bronze, fold, match_timestamp):
    rows = random_events(5, 300, 4, 3, ["program", "Program", "start", "end", "failure", "0017", "0018", "heating"])
    got = kept(bronze(*rows), case_insensitive=fold, match_timestamp=match_timestamp)
    assert got == expected(rows, 90, fold, match_timestamp)


@pytest.mark.parametrize("threshold", [60, 90, 97])
def test_one_crowded_block_matches_brute_force(bronze, monkeypatch, threshold):
    """Nearly all rows in one block with many different texts: the shared-substring step does the work."""
    monkeypatch.setattr(near_duplicates, "HEADS", 8)
    rows = random_events(7, 350, 1, 1, ["program", "start", "end", "failure", "pump", "door", "17", "18", "water"])
    rows += random_events(8, 40, 5, 2, ["program", "start"])
    assert kept(bronze(*rows), threshold=threshold) == expected(rows, threshold)


def test_many_copies_of_one_event(bronze):
    rows = [("d1", AT, WM, "Program Start")] * 200 + [("d1", AT, WM, "program start")] * 200 + [("d2", AT, WM, "End")]
    assert kept(bronze(*rows)) == [0, 400]


def test_candidate_pairs_list_every_decision(bronze):
    rows = random_events(9, 200, 3, 2, ["program", "start", "end", "failure", "17"])
    pairs = candidate_pairs(bronze(*rows)).collect()
    seen = {(p.DeviceId, p.right_timestamp, p.right_status) for p in pairs}
    firsts = {}
    for j, (device, ts, _, status) in enumerate(rows):
        firsts.setdefault((device, ts, status), j)
    keep = set(expected(rows))
    assert seen == {k for k, j in firsts.items() if j not in keep}
    for p in pairs:
        assert p.DeviceId_exact == p.DeviceType_exact == p.timestamp_exact == 1
        assert abs(p.status_fuzzy - plain_score(key(p.left_status), key(p.right_status))) < 1e-9
        assert firsts[(p.DeviceId, p.left_timestamp, p.left_status)] < firsts[(p.DeviceId, p.right_timestamp, p.right_status)]


def test_candidate_pairs_across_times(bronze):
    rows = bronze(("d1", AT, WM, "Program Start"), ("d1", "2024-01-02T10:00:00Z", WM, "Program Starts"))
    (pair,) = candidate_pairs(rows, match_timestamp=False).collect()
    assert (pair.left_status, pair.right_status, pair.timestamp_exact) == ("Program Start", "Program Starts", 0)


def test_joins_of_candidate_pairs_broadcast_nothing(bronze, capsys):
    """Files of similar texts are small, and their rows are many: the size on disk would have them broadcast."""
    rows = random_events(10, 100, 3, 2, ["program", "start", "end"])
    for timed in (True, False):
        candidate_pairs(bronze(*rows), match_timestamp=timed).explain()
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
