import json

import pytest

from coldtide.sources.discovery import Bounds, Bucket, discover, index_of, journal_keys, receipt_range
from coldtide.sources.storage import interesting

G = "11111111-2222-3333-4444-555555555555"


def found(tree, root="root", **kw):
    files = {k: (v if isinstance(v, bytes) else b"x" * v) for k, v in tree.items()}
    return discover([(k, len(v)) for k, v in files.items()], lambda k: files[k], root, **kw)


@pytest.mark.parametrize("key,keep", [
    ("a/receipt.json", True), ("a/journal.gz", True), ("a/journal.zst", True), ("a/journal.lz4", True), ("a/journal", False),
    ("a/rawdata/journal", True), ("a/rawdata/journal.x", True), ("a/rawdata/0", True), ("a/rawdata/1048576", True),
    ("a/rawdata/12a", False), ("a/rawdata/٣", False), ("a/x.tsidx", False), ("a/rawdata/x/0", False), ("x.tar.gz", False),
])
def test_interesting(key, keep):
    assert interesting(key) is keep


def test_layouts():
    tree = {
        f"web/db/db_20_10_3_{G}/rawdata/journal.gz": 5,
        "web/colddb/db_9_8_4/rawdata/journal.zst": 1,
        f"DISABLED-db_1_1_1_{G}/rawdata/journal.gz": 1,
        "app/db/hot_v1_7/rawdata/journal.gz": 2,
        "app/loose/journal.lz4": 3,
        f"net/db/2a/48/11~{G}/guidSplunk-U/rawdata/1048576": 4,
        f"net/db/2a/48/11~{G}/guidSplunk-U/rawdata/0": 4,
        f"net/db/2a/48/11~{G}/guidSplunk-U/rawdata/999": 4,
    }
    got = {b.bucket_id: b for b in found(tree)}
    assert set(got) == {f"db_20_10_3_{G}", "db_9_8_4", "hot_v1_7", "loose", f"11~{G}"}
    assert got["hot_v1_7"].newest is None and got["loose"].index == "app"
    slices = got[f"11~{G}"]
    assert [k.rsplit("/", 1)[1] for k in slices.journal_keys] == ["0", "999", "1048576"] and slices.stored_bytes == 12
    assert [b.newest for b in found(tree)] == [20, 9, None, None, None]


def test_journal_preference():
    assert journal_keys(["r/journal.lz4", "r/journal.gz", "r/journal", "r/0"]) == ("r/journal.gz",)
    assert journal_keys(["r/journal.b", "r/journal.a", "r/0"]) == ("r/journal.a",)
    assert journal_keys(["r/10", "r/9"]) == ("r/9", "r/10")


def test_replicas_and_order():
    tree = {f"web/db/rb_20_10_3_{G}/rawdata/journal.gz": 1, f"web/zdb/db_20_10_3_{G}/rawdata/journal.gz": 1, f"web/db/db_5_1_4_{G}/rawdata/journal.gz": 1}
    got = found(tree, index="web")
    assert [b.bucket_id for b in got] == [f"db_20_10_3_{G}", f"db_5_1_4_{G}"]
    assert len(found({f"a/db/db_2_1_3_{G}/rawdata/journal.gz": 1, f"b/db/db_2_1_3_{G}/rawdata/journal.gz": 1})) == 2
    both = {f"a/db/db_2_1_3_{G}/rawdata/journal.gz": 1, f"a/db/x/y/3~{G}/guidSplunk-U/rawdata/journal.zst": 1}
    assert len(found(both)) == 1


def test_copies():
    home = f"net/db/2a/48/11~{G}"
    tree = {f"{home}/guidSplunk-A/rawdata/0": 1, f"{home}/guidSplunk-B/rawdata/0": 2}
    assert found(tree)[0].stored_bytes == 1
    told = tree | {f"{home}/receipt.json": json.dumps({"objects": [{"name": "z/guidSplunk-B/rawdata/0"}]}).encode()}
    assert found(told)[0].stored_bytes == 2
    assert found(tree | {f"{home}/receipt.json": b"{no"})[0].stored_bytes == 1
    assert found(tree | {f"{home}/guidSplunk-B/rawdata/journal.zst": 7})[0].stored_bytes == 7


def test_receipt_ranges():
    assert receipt_range({"manifest": {"path": f"x/db_20_10_3_{G}"}}) == (20, 10)
    assert receipt_range({"manifest": {"earliestTime": "5", "LATEST_TIME": 9, "index_time_latest": 99}}) == (9, 5)
    assert receipt_range({"manifest": {"latest_time": 9}}) == (None, None)
    assert receipt_range({"manifest": 3}) == receipt_range(None) == (None, None)


def test_receipts_are_fetched_only_when_of_use():
    home = f"net/db/2a/48/11~{G}"
    reads = []

    def read(key):
        reads.append(key)
        return json.dumps({"manifest": {"path": f"db_20_10_3_{G}"}}).encode()

    listing = [(f"{home}/guidSplunk-A/rawdata/0", 1), (f"{home}/receipt.json", 1)]
    assert discover(listing, read, "r")[0].newest is None and not reads
    assert discover(listing, read, "r", earliest=21) == [] and reads
    assert discover(listing, read, "r", ranges=True)[0].newest == 20


@pytest.mark.parametrize("directory,pattern,index", [
    ("web/db/db_1_1_1", None, "web"), ("db/db_1_1_1", None, "root"), ("a/db/b/thaweddb/x", None, "b"), ("web/x", None, "web"),
    ("x", None, "root"), ("", None, "root"), ("2024/01/web/db_1", "^[^/]+/[^/]+/([^/]+)/", "web"), ("web/db/x", "(nothing)", "web"),
])
def test_index_names(directory, pattern, index):
    assert index_of(directory, "root", pattern) == index


def test_window_and_bounds():
    b = Bucket("web", "x", "x", (), 20, 10, 0)
    assert b.overlaps(20, None) and not b.overlaps(21, None) and b.overlaps(None, 10) and not b.overlaps(None, 9)
    assert Bucket("web", "x", "x", (), None, None, 0).overlaps(5, 6)
    bounds = Bounds()
    assert bounds.keeps(b)
    bounds.at_least(20_999)
    assert bounds.keeps(b)
    bounds.at_least(21_000)
    assert not bounds.keeps(b)
    named = Bounds()
    named.one_of(["a", "web"])
    assert named.keeps(b)
    named.one_of(["a"])
    assert not named.keeps(b)


def test_absurd_numbers_do_not_fail():
    assert len(found({f"a/db/db_{10**30}_1_1/rawdata/journal.gz": 1, f"a/db/z/rawdata/{10**25}": 1})) == 2


def test_only_a_classic_copy_replaces_a_replica():
    rb = {f"a/db/0/rb_2_1_3_{G}/rawdata/journal.gz": 1}
    remote, primary = {f"a/db/x/y/3~{G}/guidSplunk-U/rawdata/journal.zst": 1}, {f"a/zdb/db_2_1_3_{G}/rawdata/journal.gz": 1}
    ids = lambda tree: [b.bucket_id for b in found(tree, index="a")]
    assert ids(rb | remote) == [f"rb_2_1_3_{G}"] and ids(rb | primary) == [f"db_2_1_3_{G}"] and ids(rb | remote | primary) == [f"db_2_1_3_{G}"]


@pytest.mark.parametrize(
    "directory, index",
    [("sales/db/db/a7/219~G", "sales"), ("sales/db/a7/db/219~G", "sales"), ("sales/db/db/db/219~G", "sales"), ("db/db/a7/219~G", "root"), ("far/db/2a/12~G", "far"), ("db/db/12~G", "db"), ("sales/db/db/a7/other", "db")],
)
def test_a_hash_folder_named_db_is_no_home(directory, index):
    assert index_of(directory, "root") == index
