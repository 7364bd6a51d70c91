"""The stream of response files: bounded batches, broken and repeated attempts."""

import json

import pytest

from turnloom.streaming import ingest

ROW = "custom_id string, status string, language_code string"
REJECT = "id string, custom_id string, error string, content string"
TALK = '{"conversation": [{"speaker": "A", "utterance": "hi", "is_aac_user": true}], "scene": "s"}'


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "in").mkdir()

    class Place:
        out, rejects = f"{tmp_path}/out", f"{tmp_path}/rejects"

        def add(self, name, ids, bad=0):
            body = {"choices": [{"message": {"content": TALK}}]}
            lines = [json.dumps({"id": "r", "custom_id": i, "response": {"body": body}}) for i in ids]
            (tmp_path / "in" / name).write_text("\n".join(lines + ["broken"] * bad) + "\n")

        def run(self, max_files=ingest.MAX_FILES):
            ingest.ingest_stream(
                spark, f"{tmp_path}/in", self.out, self.rejects, f"{tmp_path}/checkpoint", max_files
            ).awaitTermination()

        def stored(self):
            return sorted(r.custom_id for r in ingest.read_finished(spark, self.out, ROW).collect())

        def rejected(self):
            return ingest.read_finished(spark, self.out, REJECT, self.rejects).count()

        def batches(self):
            return sorted(map(tuple, ingest.finished_batches(spark, self.out).drop("attempt").collect()))

    return Place()


def test_backlog_goes_through_in_steps(place):
    for i in range(50):
        place.add(f"{i:02d}.jsonl", [f"en_{i}", f"fr_{i}"], bad=i % 2)
    place.run(max_files=20)
    assert [b for b, _, _ in place.batches()] == [0, 1, 2]
    assert sum(n for _, n, _ in place.batches()) == 100 and sum(n for _, _, n in place.batches()) == 25
    expected = sorted(f"{lang}_{i}" for i in range(50) for lang in ("en", "fr"))
    assert place.stored() == expected and place.rejected() == 25
    place.add("late.jsonl", ["de_1"])
    place.run(max_files=20)
    assert place.stored() == sorted([*expected, "de_1"]) and len(place.batches()) == 4


def test_broken_attempt_is_not_read_and_is_done_again(place, monkeypatch):
    for i in range(6):
        place.add(f"{i}.jsonl", [f"en_{i}"], bad=1)
    whole, calls = ingest.write_rejects, []

    def failing(bad, path, mode):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("executor lost")
        whole(bad, path, mode)

    monkeypatch.setattr(ingest, "write_rejects", failing)
    with pytest.raises(Exception, match="executor lost"):
        place.run(max_files=2)
    assert len(place.stored()) == 2 and place.rejected() == 2 and len(place.batches()) == 1
    monkeypatch.setattr(ingest, "write_rejects", whole)
    place.run(max_files=2)
    assert place.stored() == [f"en_{i}" for i in range(6)] and place.rejected() == 6
    assert [b for b, _, _ in place.batches()] == [0, 1, 2]


def test_batch_finished_twice_is_read_once(spark, place):
    """A run that stops between the ledger and the checkpoint does its last batch again."""
    place.add("a.jsonl", ["en_1", "en_2"])
    place.run()
    rows = spark.read.json(f"{place.out}/batch=0")
    rows.drop("attempt").write.partitionBy("language_code").json(f"{place.out}/batch=0/attempt=b")
    spark.createDataFrame([(0, "b", 2, 0)], ingest.LEDGER).write.mode("append").parquet(f"{place.out}/_finished")
    assert place.stored() == ["en_1", "en_2"] and place.batches() == [(0, 2, 0)]


def test_nothing_to_read(place):
    place.run()
    assert place.stored() == [] and place.batches() == []
