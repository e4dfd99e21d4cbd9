"""Jobs from files to files, with a restart in between."""

import json
import resource
import subprocess
import sys

import numpy as np
import pytest
from tokenizers import Tokenizer

from corpusmill.functions import patterns as P
from corpusmill.operators import distill, resume
from corpusmill.plans import jobs
from corpusmill.sources import corpus, packed


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("bpe")
    (at / "lines.txt").write_text("\n".join(f"السلام عليكم يا صاحبي وين رايح {i % 7}" if i % 5 else "" for i in range(600)))
    made = jobs.train_file(spark, str(at / "lines.txt"), str(at / "t.json"), vocabulary=320, fraction=0.2)
    assert made["train_lines"] + made["holdout_lines"] == 480 and made["vocabulary"] <= 320
    return at


def test_report(spark, trained):
    assert jobs.report_file(spark, str(trained / "lines.txt"), str(trained / "t.json"), str(trained / "out" / "r.json"), fraction=0.2) == 0
    report = json.loads((trained / "out" / "r.json").read_text())
    assert report["morph_f1"] is None and report["fertility"] > 0 and isinstance(report["warnings"], list)


def test_pack(spark, trained, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "b.txt").write_text("السلام عليكم\n\n  وين رايح \n")
    (raw / "a.txt").write_text("يا صاحبي\n")
    (tmp_path / "talk").write_text('{"user": "وين", "assistant": "رايح", "dialect": "najdi"}\n')
    spec = (trained / "t.json").read_text()
    bpe = Tokenizer.from_str(spec)
    texts = ["يا صاحبي", "السلام عليكم", "وين رايح", "وين رايح"]
    want = [bpe.encode(t, add_special_tokens=False).ids for t in texts]
    # byte-level pieces of Arabic letters count as single characters for a small vocabulary; the gate is tested on its own
    bad = {i for i, t in __import__("corpusmill.operators.tokenizer", fromlist=["x"]).token_strings(spec).items() if len(t) == 1}
    out = str(tmp_path / "p")
    if any(i in bad for x in want for i in x):
        assert jobs.pack_main(spark, str(raw), str(tmp_path / "talk"), str(trained / "t.json"), out) == 1
        return
    meta = jobs.pack_files(spark, str(raw), str(tmp_path / "talk"), str(trained / "t.json"), out)
    assert (meta["rows_raw"], meta["rows_synthetic"], meta["total_tokens"]) == (3, 1, sum(map(len, want)))
    with np.load(f"{out}.index.npz") as z:
        assert z["starts"].tolist() == [0, *np.cumsum([len(x) for x in want])[:-1]] and z["kind"].tolist() == [0, 0, 0, 1]
    assert np.fromfile(f"{out}.bin", np.uint16).tolist() == [i for x in want for i in x]


def test_write_joins_the_parts_in_order(spark, tmp_path):
    rows = spark.range(3000).selectExpr("cast(id % 2 as byte) as kind", "id as row_idx", "transform(sequence(1, cast(id % 5 as int) + 1), x -> cast(id % 60000 as int)) as ids").repartition(7)
    meta = packed.write(rows, str(tmp_path / "p"), vocabulary=65_000, tokenizer_hash="x")
    order = sorted(range(3000), key=lambda i: (i % 2, i))
    want = [i for i in order for _ in range(i % 5 + 1)]
    assert np.fromfile(tmp_path / "p.bin", np.uint16).tolist() == want and meta["total_tokens"] == len(want)
    assert sorted(f.name for f in tmp_path.iterdir()) == ["p.bin", "p.index.npz", "p.meta.json"]
    with pytest.raises(Exception, match="fit 16 bits"):
        packed.write(spark.createDataFrame([(0, 0, [70_000])], "kind byte, row_idx long, ids array<int>"), str(tmp_path / "q"), vocabulary=65_000, tokenizer_hash="x")
    assert not (tmp_path / "q.bin").exists()


def test_distill_with_a_restart(spark, tmp_path):
    meta, out, anchors = (str(tmp_path / x) for x in ("meta", "out", "anchors"))
    corpus.metadata_fixture(spark).coalesce(1).write.parquet(meta)
    rows = corpus.metadata_fixture(spark).collect()
    routed = [r for r in rows if P.MULTI_SPEAKER in (r.speaker_age, r.speaker_gender, r.speaker_dialect) or r.speaker_dialect in ("Najdi", "Hijazi")]

    def short_of_money(url, headers, body):
        return (402, {}, "") if routed[-1].text in json.loads(body)["messages"][1]["content"] else distill.canned(url, headers, body)

    with pytest.raises(Exception, match="payment"):
        jobs.distill_files(spark, meta, out, anchors, distill.Config(), short_of_money, chunk_rows=4)
    before, done = corpus.dialogues(spark, out).count(), resume.load(spark, anchors).count()
    assert 0 < before and 0 < done < len(routed)
    calls = []
    counts = jobs.distill_files(spark, meta, out, anchors, distill.Config(), distill.canned, chunk_rows=7)
    said = [r.user for r in corpus.dialogues(spark, out).collect()]
    assert counts["total"] == counts["succeeded"] < len(routed) and before + counts["appended"] == len(said) == len(set(said)) == len({r.text for r in routed}), calls
    assert jobs.distill_files(spark, meta, out, anchors, distill.Config(), distill.canned)["total"] == 0


READ = """
import resource, sys
sys.path.insert(0, {repo!r})
from corpusmill.sources import packed
loader = packed.Loader({path!r}, indexed=False)
before = anonymous = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("RssAnon")).split()[1])
start, n = anonymous(), 0
for b in loader.batches(32, 1024):
    n += b.size
print(n, anonymous() - start)
"""


def test_flat_read_stays_within_50_mb(tmp_path):
    """A read of 100 million ids in batches of 32 x 1024 adds less than 50 MB of memory of its own."""
    import os

    np.random.default_rng(0).integers(0, 65_536, 100_000_000, dtype=np.uint16).tofile(tmp_path / "big.bin")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", READ.format(repo=repo, path=str(tmp_path / "big"))], capture_output=True, text=True, check=True, timeout=300).stdout.split()
    assert int(out[-2]) >= 100_000_000 and int(out[-1]) < 50 * 1024
    assert resource.getpagesize()
