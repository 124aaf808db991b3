"""The command line: python -m recordloom COMMAND. Tables are folders of TSV parts; a result is never written over an existing one.

Sizes of chunks aren't options: Spark splits files whose lines are rows by spark.sql.files.maxPartitionBytes, and reads the others a file a task.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import blocking, cleaning, decide, evaluate, features, model, output
from .plans.views import stored
from .sources import tsv

PAIRS = ["source1_entity_id", "candidate_entity_id", "blocking_method"]
TARGETS = (2, 3)
#: What the fast scorers cut a logit to.
FAST_CLIP = 40.0


def _absent(spark: SparkSession, *paths: str) -> None:
    for p in paths:
        if tsv.exists(spark, p):
            raise FileExistsError(p)


def _lines(df: DataFrame) -> list[str]:
    """A small table of figures as text, in order."""
    return ["\t".join(df.columns), *("\t".join("" if x is None else str(x) for x in r) for r in df.orderBy(*df.columns).collect()), ""]


def _report(lines: Iterable[str], spark: SparkSession | None = None, path: str | None = None) -> None:
    text = "\n".join(lines)
    print(text)
    if path:
        tsv.write_text(spark, text + "\n", path)


def records(spark: SparkSession, data_dir: str, split: str, sources: Iterable[int] = (1, 2, 3)) -> DataFrame:
    """Cleaned records of a split with src; entity_id is the stripped one, as in the candidates and the truth."""
    columns = [*tsv.RECORD, *(f"{c}_normalized" for c in tsv.RECORD)]
    out = None
    for n in sources:
        one = tsv.read(spark, f"{data_dir}/{split}/{split}_source{n}_cleaned.tsv", columns).withColumn("entity_id", F.col("entity_id_normalized")).withColumn("src", F.lit(n))
        out = one if out is None else out.unionByName(one)
    return out


def truth(spark: SparkSession, data_dir: str) -> DataFrame:
    columns = [*tsv.TRUTH, *(f"{c}_normalized" for c in tsv.TRUTH)]
    rows = tsv.read(spark, f"{data_dir}/train/train_ground_truth_cleaned.tsv", columns)
    return cleaning.truth_pairs(rows.select(*[F.col(f"{c}_normalized").alias(c) for c in tsv.TRUTH]))


def candidates(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """(src, s1, cand, blocking_method) of files of candidates; repeats stay."""
    out = None
    for n, path in paths.items():
        one = tsv.read(spark, path, PAIRS).select(F.lit(n).alias("src"), *[F.col(a).alias(b) for a, b in zip(PAIRS, ("s1", "cand", "blocking_method"))])
        out = one if out is None else out.unionByName(one)
    return out


def _of(candidate_dir: str) -> dict[int, str]:
    return {n: f"{candidate_dir}/candidate_pairs_source{n}.tsv" for n in TARGETS}


def _exported(pairs: DataFrame) -> DataFrame:
    return pairs.select(*[F.col(b).alias(a) for a, b in zip(PAIRS, ("s1", "cand", "blocking_method"))])


def clean(spark: SparkSession, a) -> None:
    staging = f"{a.output}/_staging"
    paths = tsv.unzip(spark, a.input, staging) if a.input.endswith(".zip") else tsv.find(spark, a.input)
    if not paths:
        raise FileNotFoundError(f"no TSV files of a split in {a.input}")
    to = {p: f"{a.output}/{tsv.cleaned_name(p)}" for p in paths}
    _absent(spark, *to.values())
    for p, target in to.items():
        df = cleaning.add_normalized(tsv.read(spark, p, tsv.TRUTH if "ground_truth" in p.rpartition("/")[2] else tsv.RECORD))
        tsv.write(df, target)
        _report([target, *_lines(cleaning.profile(df))])
    tsv.delete(spark, staging)


def inspect(spark: SparkSession, a) -> None:
    """Headers, counts and first rows of the files; of the truth what its lists hold, and its first examples with their records."""
    paths = {p.rpartition("/")[2]: p for p in tsv.find(spark, a.data_dir)}
    counts = {}
    for name, p in paths.items():
        df = tsv.read(spark, p, tsv.TRUTH if "ground_truth" in name else tsv.RECORD)
        header, rows = tsv.preview(df)
        counts[name] = df.count()
        _report([f"{name}: {counts[name]} rows", "\t".join(header), *("\t".join(r) for r in rows), ""])
    if "train_ground_truth.tsv" in paths:
        lists = tsv.read(spark, paths["train_ground_truth.tsv"], tsv.TRUTH)
        examples = stored(cleaning.match_list_examples(lists, a.examples))
        _report([*_lines(cleaning.match_list_profile(lists)), *_lines(examples)])
        sources = {n: paths[f"train_source{n}.tsv"] for n in (1, 2, 3) if f"train_source{n}.tsv" in paths}
        ids = examples.select(F.explode(F.concat(F.array("source1_entity_id"), cleaning.match_ids(F.col(cleaning.LIST_COLUMN)))).alias("entity_id")).distinct()
        if sources:
            _report(_lines(tsv.records(spark, sources).join(ids, "entity_id", "left_semi").select("src", *tsv.RECORD)))
        if 1 in sources:
            _report(f"{k}: {v}" for k, v in cleaning.count_check({"ground truth against source 1": (counts["train_ground_truth.tsv"], counts["train_source1.tsv"])}).items())


def generate(spark: SparkSession, a) -> None:
    paths = _of(a.output_dir)
    _absent(spark, *paths.values())
    own = records(spark, a.data_dir, a.split)
    pairs = stored(blocking.candidates(stored(blocking.keys(own, a.fast_exact_only))))
    for n, path in paths.items():
        one = _exported(pairs.where(F.col("src") == n))
        tsv.write(one, path, PAIRS[:2])
        if tsv.read(spark, path, PAIRS).count() != one.count():
            raise ValueError(f"{path} doesn't hold all pairs")
    size = evaluate.sizes(own, pairs)
    methods = pairs.groupBy("src", "blocking_method").agg(F.count("*").alias("pairs"))
    _report([*_lines(evaluate.percentiles(evaluate.sizes(own, pairs, zero=False))), *_lines(evaluate.candidate_report(own, pairs)), *_lines(evaluate.histogram(size)), *_lines(methods)], spark, f"{a.output_dir}/candidate_report.txt")


def generate_exact(spark: SparkSession, a) -> None:
    pairs = blocking.exact_lookup(records(spark, a.data_dir, a.split, (1, a.source)))
    tsv.replace(_exported(pairs), a.output, order=PAIRS[:2])


def recall(spark: SparkSession, a) -> None:
    own, true, found = records(spark, a.data_dir, "train"), truth(spark, a.data_dir), candidates(spark, _of(a.candidate_dir))
    if a.report:
        _absent(spark, a.report)
    once = stored(found.dropDuplicates(["src", "s1", "cand"]))
    missing = stored(evaluate.missing_truth(true, once, 10))
    ids = missing.select(F.explode(F.array("s1", "cand")).alias("entity_id")).distinct()
    of_missing = own.join(ids, "entity_id", "left_semi").select("src", *tsv.RECORD)
    parts = [evaluate.recall_metrics(own, true, once), evaluate.recall_report(own, true, found), evaluate.percentiles(evaluate.sizes(own, once)), evaluate.retained_by_method(true, once), evaluate.duplicate_pairs(found), missing, of_missing]
    _report([x for df in parts for x in _lines(df)], spark, a.report)


def train(spark: SparkSession, a) -> None:
    """Weights from the training part of source 1's records, thresholds from the validation part."""
    _absent(spark, a.artifact_dir)
    own, true = records(spark, a.data_dir, "train"), truth(spark, a.data_dir)
    groups = model.with_group(own.where("src = 1")).select(F.col("entity_id").alias("s1"), "is_validation").distinct()
    found = candidates(spark, _of(a.candidate_dir)).dropDuplicates(["src", "s1", "cand"])
    pairs = stored(model.labelled(features.pair_features(found, own), true).join(groups, "s1"))
    sample = model.train_sample(pairs)
    fitted = {n: model.train_sgd(sample, n, a.learning_rate) if a.solver == "sgd" else model.train_lbfgs(sample, n) for n in TARGETS}
    made = model.Model({n: w for n, (w, _) in fitted.items()}, {n: b for n, (_, b) in fitted.items()})
    scored = stored(model.score(pairs.where("is_validation = 1"), made).select("src", "s1", "cand", "score"))
    held = groups.where("is_validation = 1").select("s1")
    grid = stored(evaluate.threshold_grid(spark, held, true.join(held, "s1", "left_semi"), scored, model.THRESHOLDS))
    best = evaluate.best_thresholds(grid)
    chosen = best.first()
    made.threshold = {2: chosen["t2"], 3: chosen["t3"]} if chosen else {n: 0.5 for n in TARGETS}
    model.save(spark, made, f"{a.artifact_dir}/model")
    _report([*_lines(model.positive_weight(sample)), *_lines(evaluate.validation_report(best))], spark, f"{a.artifact_dir}/validation_report.txt")


def predict(spark: SparkSession, a) -> None:
    to = {c: f"{a.output_dir}/{name}.tsv" for c, name in (("matched_entity_ids", "matching_results"), ("candidate_entity_ids", "candidate_pairs"))}
    _absent(spark, *to.values())
    if not a.skip_candidate_generation:
        generate(spark, argparse.Namespace(data_dir=a.data_dir, split="test", output_dir=a.candidate_dir, fast_exact_only=a.fast_candidates))
    own, made = records(spark, a.data_dir, "test"), model.load(spark, a.model)
    found = candidates(spark, _of(a.candidate_dir)).dropDuplicates(["src", "s1", "cand"])
    scored = stored(model.score(features.pair_features(found, own), made).select("src", "s1", "cand", "score"))
    for column, pairs in (("matched_entity_ids", decide.by_source_threshold(scored, made.threshold)), ("candidate_entity_ids", found)):
        tsv.write(output.checked(stored(output.grouped(own, pairs, column)), own), to[column], ["source1_entity_id"])
        tsv.check_size(spark, to[column])


def _fast(spark: SparkSession, a, n: int) -> tuple[DataFrame, DataFrame]:
    """Records of source 1 and n, and the matches among the pairs that agree in the exact name and the exact address."""
    own, made = records(spark, a.data_dir, "test", (1, n)), model.load(spark, a.model)
    pairs = features.pair_features(candidates(spark, {n: a.candidates}).dropDuplicates(["src", "s1", "cand"]), own)
    methods = F.split("blocking_method", ",")
    scored = model.score(pairs.where(F.array_contains(methods, "exact_name") & F.array_contains(methods, "exact_address")), made, FAST_CLIP)
    return own, decide.by_source_threshold(stored(scored.select("src", "s1", "cand", "score")), made.threshold)


def score_exact(spark: SparkSession, a) -> None:
    own, matches = _fast(spark, a, 2)
    tsv.replace(output.checked(stored(output.grouped(own, matches, "matched_entity_ids")), own), a.output, order=["source1_entity_id"])


def merge_exact(spark: SparkSession, a) -> None:
    own, matches = _fast(spark, a, 3)
    tsv.replace(output.checked(stored(output.merge(tsv.read(spark, a.matching, tsv.TRUTH), matches)), own), a.output or a.matching, order=["source1_entity_id"])


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="recordloom", description="Record linkage of business records of three sources.")
    commands = out.add_subparsers(required=True)

    def command(name: str, run, text: str, *needed: str):
        c = commands.add_parser(name, help=text)
        c.set_defaults(run=run)
        for option in needed:
            c.add_argument(f"--{option}", required=True)
        return c

    command("clean", clean, "clean raw files of a folder or a ZIP archive", "input", "output")
    command("inspect", inspect, "show what raw files hold", "data-dir").add_argument("--examples", type=int, default=3)
    c = command("generate-candidates", generate, "candidate pairs of both target sources", "data-dir", "output-dir")
    c.add_argument("--split", choices=tsv.SPLITS, default="train")
    c.add_argument("--fast-exact-only", action="store_true")
    c = command("generate-exact", generate_exact, "candidate pairs that agree in country, name and address", "data-dir", "output")
    c.add_argument("--split", choices=tsv.SPLITS, default="test")
    c.add_argument("--source", type=int, choices=TARGETS, default=2)
    command("validate-recall", recall, "how much of the truth candidates retain", "data-dir", "candidate-dir").add_argument("--report")
    c = command("train", train, "train the scorer and choose its thresholds", "data-dir", "candidate-dir", "artifact-dir")
    c.add_argument("--learning-rate", type=float, default=model.RATE)
    c.add_argument("--solver", choices=("sgd", "lbfgs"), default="sgd")
    c = command("predict", predict, "matches of the test split", "data-dir", "model", "candidate-dir", "output-dir")
    c.add_argument("--skip-candidate-generation", action="store_true")
    c.add_argument("--fast-candidates", action="store_true")
    command("score-exact", score_exact, "matches of source 2 among exact pairs", "data-dir", "candidates", "model", "output")
    command("merge-exact", merge_exact, "add matches of source 3 among exact pairs", "data-dir", "candidates", "model", "matching").add_argument("--output")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    a.run(spark or SparkSession.builder.appName("recordloom").getOrCreate(), a)
