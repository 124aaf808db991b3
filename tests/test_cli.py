import os
import zipfile

import pytest

from recordloom import cli
from recordloom.sources import tsv


def _rows(spark, path, columns):
    return sorted(tuple(r) for r in tsv.read(spark, str(path), columns).collect())


def test_from_raw_files_to_matches(spark, tmp_path):
    word = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove", "heron", "inlet", "jolly"]
    name = lambda i: f"{word[i % 10]} {word[i // 10]} works"
    address = lambda i: f"{100 + i} {word[(7 * i) % 10]} lane 5600{i:02d}"
    raw = {}
    for split in tsv.SPLITS:
        for n in (1, 2, 3):
            # Of source 2 every record is a copy, of source 3 every second one; the others share the name alone.
            body = [f"S{n}-{i}\t{name(i).upper() if n > 1 else name(i)}\t{address(i) if n < 3 or i % 2 == 0 else address(99 - i)}\tIN" for i in range(40)]
            raw[f"x/dataset/{split}/{split}_source{n}.tsv"] = "\n".join(["entity_id\tbusiness_name\tbusiness_address\tcountry", *body]) + "\n"
    lists = [f"S1-{i}\tS2-{i}" + (f", S3-{i}" if i % 2 == 0 else "") for i in range(40)]
    raw["x/dataset/train/train_ground_truth.tsv"] = "\n".join(["source1_entity_id\tmatched_entity_ids", *lists]) + "\n"
    with zipfile.ZipFile(tmp_path / "raw.zip", "w") as z:
        for path, text in raw.items():
            z.writestr(path, text)
    run = lambda line: cli.main([x.replace("@", f"{tmp_path}/") for x in line.split()], spark)
    run("clean --input @raw.zip --output @clean")
    assert sorted(os.listdir(tmp_path / "clean")) == ["test", "train"]
    with pytest.raises(FileExistsError):
        run("clean --input @raw.zip --output @clean")
    tsv.unzip(spark, str(tmp_path / "raw.zip"), str(tmp_path / "raw"))
    run("inspect --data-dir @raw --examples 2")
    run("generate-candidates --data-dir @clean --output-dir @cand")
    run("validate-recall --data-dir @clean --candidate-dir @cand --report @recall.txt")
    report = (tmp_path / "recall.txt").read_text().splitlines()
    head = report[0].split("\t")
    assert [dict(zip(head, line.split("\t")))["recall"] for line in report[1:3]] == ["1.0", "1.0"]
    run("train --data-dir @clean --candidate-dir @cand --artifact-dir @art --solver lbfgs")
    run("predict --data-dir @clean --model @art/model --candidate-dir @cand_test --output-dir @out")
    got = dict(_rows(spark, tmp_path / "out" / "matching_results.tsv", tsv.TRUTH))
    assert got == {f"S1-{i}": f"S2-{i}" + (f",S3-{i}" if i % 2 == 0 else "") for i in range(40)}
    assert len(_rows(spark, tmp_path / "out" / "candidate_pairs.tsv", ["source1_entity_id", "candidate_entity_ids"])) == 40
    for n in (2, 3):
        run(f"generate-exact --data-dir @clean --source {n} --output @exact{n}.tsv")
    assert _rows(spark, tmp_path / "exact3.tsv", cli.PAIRS[:2]) == sorted((f"S1-{i}", f"S3-{i}") for i in range(0, 40, 2))
    run("score-exact --data-dir @clean --candidates @exact2.tsv --model @art/model --output @fast.tsv")
    run("merge-exact --data-dir @clean --candidates @exact3.tsv --model @art/model --matching @fast.tsv")
    fast = dict(_rows(spark, tmp_path / "fast.tsv", tsv.TRUTH))
    assert len(fast) == 40 and all(set(filter(None, v.split(","))) <= set(got[k].split(",")) for k, v in fast.items())
