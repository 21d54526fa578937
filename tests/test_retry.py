"""Refused requests are sent again by themselves, whole bodies never."""

import json
import os

import pytest

from changeflow.operators.bulk import bulk_errors
from changeflow.plans import sync
from changeflow.sources.bulk import post_lines, refused_places, send_settled
from tests.test_state import REQUESTS


def requests_of(spark, n):
    rows = [(1, "bin.000001", k, 0, 0, "index", "i", str(k), "", "", {"v": str(k)}) for k in range(n)]
    return spark.createDataFrame(rows, REQUESTS).coalesce(1)


def ids_of(body):
    return [json.loads(line)["index"]["_id"] for line in body.splitlines()[::2]]


def answer(ids, bad=()):
    items = [{"index": {"_index": "i", "_id": i, "status": 429 if i in bad else 200, **({"error": "busy"} if i in bad else {})}} for i in ids]
    return 200, json.dumps({"took": 1, "errors": bool(bad), "items": items})


def test_places_of_refused_requests():
    assert refused_places(200, answer("abc", "b")[1], 3)[0] == [1]
    assert refused_places(429, answer("abc", "abc")[1], 3)[0] == [0, 1, 2]
    for text in ("", "no json", "[]", "{}", '{"items":[]}', answer("ab")[1], '{"items":[1,2,3]}'):
        assert refused_places(200, text, 3) is None


def test_only_the_refused_request_is_sent_again():
    bodies = []

    def twice(body):
        bodies.append(ids_of(body))
        return answer(bodies[-1], {"5"} if len(bodies) < 3 else ())

    lines = [f'{{"index":{{"_id":"{k}"}}}}\n{{}}' for k in range(128)]
    code, text, sent = post_lines(lines, twice, attempts=3, backoff_seconds=0)
    assert (code, sent) == (200, 3) and bodies == [[str(k) for k in range(128)], ["5"], ["5"]]
    told = json.loads(text)
    assert not told["errors"] and [x["index"]["_id"] for x in told["items"]] == bodies[0]


def test_what_is_refused_to_the_end_is_told():
    lines = [f'{{"index":{{"_id":"{k}"}}}}\n{{}}' for k in range(4)]
    seen = []

    def some(body):
        seen.append(ids_of(body))
        return answer(seen[-1], {"1", "3"} if len(seen) == 1 else {"3"})

    code, text, sent = post_lines(lines, some, attempts=4, backoff_seconds=0)
    assert seen == [["0", "1", "2", "3"], ["1", "3"], ["3"], ["3"]] and sent == 4
    assert [x["index"].get("error") for x in json.loads(text)["items"]] == [None, None, None, "busy"]


@pytest.mark.parametrize("reply", [(503, ""), (200, '{"took":1,"errors":false,"items":[]}'), (200, answer("ab")[1])])
def test_a_body_is_never_sent_again(reply):
    seen = []
    code, text, sent = post_lines(["x"] * 3, lambda body: seen.append(body) or reply, backoff_seconds=0)
    assert (code, text, sent, len(seen)) == (*reply, 1, 1)


def test_a_failed_second_answer_keeps_the_first():
    seen = []

    def breaks(body):
        seen.append(ids_of(body))
        return answer(seen[-1], {"1"}) if len(seen) == 1 else (503, "")

    code, text, sent = post_lines([f'{{"index":{{"_id":"{k}"}}}}\n{{}}' for k in range(2)], breaks, backoff_seconds=0)
    assert sent == 2 and json.loads(text)["errors"] and json.loads(text)["items"][1]["index"]["error"] == "busy"


def test_retries_in_tasks(spark, tmp_path):
    seen = str(tmp_path / "seen")
    os.mkdir(seen)

    def refuses_twice(body):
        ids = ids_of(body)
        count = len(os.listdir(seen))
        open(f"{seen}/{count:03d}", "w").write(",".join(ids))
        tried = sum("77" in open(f"{seen}/{f}").read().split(",") for f in os.listdir(seen))
        return answer(ids, {"77"} if "77" in ids and tried < 3 else ())

    requests = requests_of(spark, 300)
    sent = send_settled(sync.settled_requests(requests).coalesce(1), refuses_twice, 128, backoff_seconds=0).collect()
    assert sorted(r.requests for r in sent) == [44, 128, 128] and sorted(r.sent for r in sent) == [1, 1, 3]
    bodies = [open(f"{seen}/{f}").read().split(",") for f in sorted(os.listdir(seen))]
    assert len(bodies) == 5 and bodies.count(["77"]) == 2
    errors = spark.createDataFrame(sent)
    assert bulk_errors(errors, body="response").count() == 0
    with pytest.raises(sync.BulkFailed, match="busy"):
        sync.send_requests(requests, lambda body: answer(ids_of(body), {"7"}), attempts=2, backoff_seconds=0)
