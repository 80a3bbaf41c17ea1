"""Chains of pages, their holes, and rounds over several micro-batches."""

import json

from conftest import T0
from datetime import timedelta

from burstwatch.sources.chains import ROUND_MARK, ROUND_PAGE, assemble, moved_marks, page_positions, stream_page_rounds
from burstwatch.sources.tables import read_comments
from burstwatch.streaming.rounds import round_marks, stream_rounds, waiting_pages


def item(c, s=0):
    return {"id": c, "snippet": {"topLevelComment": {"snippet": {
        "authorChannelId": {"value": "a"}, "textOriginal": c, "publishedAt": (T0 + timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%SZ")}}}}


def pages(spark, rows):
    """rows: (video, round, token, next, ids)."""
    data = [json.dumps({"video_id": v, "round": r, "pageToken": t, "nextPageToken": n, "items": [item(c) for c in ids]}) for v, r, t, n, ids in rows]
    return spark.read.schema(ROUND_PAGE).json(spark.sparkContext.parallelize(data, 3))


def test_positions_holes_rings_and_repeats(spark):
    long = [("v", 1, f"p{k}" if k else None, f"p{k + 1}" if k < 40 else None, [f"c{k}"]) for k in range(41)]
    rows = long[::-1] + long[5:9]  # landed twice
    rows += [("v", 2, None, "p1", ["x"]), ("v", 2, "p2", None, ["y"])]  # p1 is not there
    rows += [("w", 1, "a", "b", ["r"]), ("w", 1, "b", "a", ["s"]), ("w", 1, None, None, ["t"])]  # a ring beside
    rows += [(None, 1, None, "p1", ["n0"]), (None, 1, "p1", None, ["n1"])]
    got = {(r.video_id, r.round, r.token): r.position for r in page_positions(pages(spark, rows)).collect()}
    assert len(got) == 41 + 2 + 3 + 2
    assert all(got["v", 1, f"p{k}" if k else ""] == k for k in range(41))
    assert got["v", 2, ""] == 0 and got["v", 2, "p2"] is None
    assert got["w", 1, "a"] is None and got["w", 1, "b"] is None and got["w", 1, ""] == 0
    assert got[None, 1, "p1"] == 1


def test_items_up_to_the_stop_of_complete_chains_only(spark):
    marks = spark.createDataFrame([("v", "stop", 1), ("w", "gone", 1), ("h", "stop", 1), (None, "n2", 1)], ROUND_MARK)
    rows = [("v", 2, None, "p1", ["c1", "c2"]), ("v", 2, "p1", "p2", ["c3", "stop", "c4"]),  # p2 was never fetched
            ("w", 2, None, "p1", ["w1"]), ("w", 2, "p1", None, ["w2", "w3"]),                # the stop is gone: all
            ("h", 2, None, "p1", ["h1"]), ("h", 2, "p2", None, ["stop"]),                    # a hole
            ("f", 2, "p1", None, ["f1"]),                                                    # the first page is missing
            ("e", 2, None, None, []), (None, 2, None, "p1", ["n1", "n2"])]
    chains, items = assemble(pages(spark, rows), marks)
    got: dict = {}
    for r in items.orderBy("video_id", "position", "idx").collect():
        got.setdefault(r.video_id, []).append(r["item"]["id"])
    assert got == {"v": ["c1", "c2", "c3"], "w": ["w1", "w2", "w3"], None: ["n1"]}
    state = {r.video_id: (r.pages, r.complete, r.missing) for r in chains.collect()}
    assert state == {"v": (2, True, None), "w": (2, True, None), "h": (1, False, "p1"), "f": (0, False, ""),
                     "e": (1, True, None), None: (1, True, None)}
    moved = {r.video_id: (r.mark_id, r.mark_round) for r in moved_marks(marks, chains).collect()}
    assert moved == {"v": ("c1", 2), "w": ("w1", 2), "h": ("stop", 1), None: ("n1", 2)}
    back = moved_marks(spark.createDataFrame([("v", "newer", 9)], ROUND_MARK), chains.where("video_id = 'v'")).collect()
    assert [tuple(r) for r in back] == [("v", "newer", 9)]


def test_no_pages(spark):
    chains, items = assemble(pages(spark, []), spark.createDataFrame([], ROUND_MARK))
    assert chains.count() == 0 and items.count() == 0


def test_a_hole_holds_the_mark_back_until_it_is_filled(spark, tmp_path):
    landed, root = tmp_path / "landed", str(tmp_path / "root")
    landed.mkdir()

    def land(name, rows):
        (landed / name).write_text("\n".join(json.dumps(
            {"video_id": v, "round": r, "pageToken": t, "nextPageToken": n, "items": [item(c, int(c[1:])) for c in ids]})
            for v, r, t, n, ids in rows))

    def run():
        stream_rounds(stream_page_rounds(spark, str(landed), 1), root, trigger={"availableNow": True}).awaitTermination()
        marks = {r.video_id: r.mark_id for r in round_marks(spark, root).collect()}
        return marks, sorted(r.comment_id for r in read_comments(spark, f"{root}/comments").collect())

    land("1.json", [("v", 1, None, "p1", ["c9", "c8"]), ("v", 1, "p1", None, ["c7"]), ("w", 1, None, None, ["d5"])])
    assert run() == ({"v": "c9", "w": "d5"}, ["c7", "c8", "c9", "d5"])
    land("2.json", [("v", 2, None, "p1", ["c14", "c13"]), ("w", 2, None, "p1", ["d7", "d6"]), ("w", 2, "p1", "p2", ["d5"])])
    assert run() == ({"v": "c9", "w": "d7"}, ["c7", "c8", "c9", "d5", "d6", "d7"])
    assert waiting_pages(spark, root).count() == 1
    land("3.json", [("v", 3, None, "p1", ["c16", "c15"]), ("v", 3, "p1", "p2", ["c14", "c13"])])
    assert run()[0]["v"] == "c9"  # its stop is not there yet
    land("4.json", [("v", 2, "p1", "p2", ["c12", "c9", "c8"])])  # the late page
    marks, ids = run()
    assert marks == {"v": "c16", "w": "d7"} and waiting_pages(spark, root).count() == 0
    assert ids == sorted([f"c{k}" for k in (7, 8, 9, 12, 13, 14, 15, 16)] + ["d5", "d6", "d7"])
