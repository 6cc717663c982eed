"""Train, predict, check and package over small files; the driver's contract."""

import subprocess
import sys
import zipfile
from pathlib import Path

import pytest
import yaml

import __spark_entry__ as contract
from linkloom import cli
from linkloom.config import load_config
from linkloom.plans import link
from linkloom.sources import tsv

S1 = [
    ("1", "Acme Robotics Inc", "123 Innovation Drive, San Jose, CA 95110", "US"),
    ("2", "Delta Foods Corporation", "456 Market Street, Chicago, IL 60601", "US"),
    ("3", "Bright Cafe LLC", "789 Oak Avenue, Austin, TX 78701", "US"),
    ("4", "Zen Traders Pvt Ltd", "14 MG Road, Bangalore 560001", "IN"),
    ("5", "Le Petit Bistro SARL", "25 Rue de Rivoli, Paris 75001", "FR"),
    ("6", "Solitary Goods Co", "999 Nowhere Blvd, Unknown City, TX 99999", "US"),
]
S2 = [
    ("1", "Acme Robotics Inc.", "123 Innovation Drive San Jose CA 95110", "US"),
    ("2", "Delta Foods Corp", "456 Market St, Chicago Illinois 60601", "US"),
    ("3", "Bright Cafe", "789 Oak Ave Austin TX", "US"),
    ("4", "Zen Traders Private Limited", "14 Mahatma Gandhi Road Bangalore 560001", "IN"),
    ("5", "Le Petit Bistro", "25 rue de Rivoli Paris", "FR"),
    ("6", "Some Unrelated Corp", "1 Wall Street New York NY", "US"),
]
S3 = [(i, n.upper(), a.replace(",", ""), c) for i, n, a, c in S1[:5]] + [("6", "Completely Different Entity", "50 Fifth Avenue New York", "US")]


def write(folder, copies):
    folder.mkdir(parents=True)
    for n, rows in ((1, S1), (2, S2), (3, S3)):
        lines = [f"S{n}-{k}{i}\t{name} {k}\t{address}\t{c}" for k in range(copies) for i, name, address, c in rows]
        (folder / f"source{n}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "\n".join(lines) + "\n")
    pairs = [f"S1-{k}{i}\tS{n}-{k}{i}\tsource{n}" for k in range(copies) for i in "12345" for n in (2, 3)]
    (folder / "ground_truth.tsv").write_text("source1_entity_id\tsource_id\tsource_tag\n" + "\n".join(pairs) + "\n")


@pytest.fixture(scope="module")
def workspace(tmp_path_factory):
    at = tmp_path_factory.mktemp("work")
    write(at / "data" / "train", 6)
    write(at / "data" / "test", 2)
    (at / "c.yaml").write_text(yaml.safe_dump({
        "paths": {k: f"{at}/{v}" for k, v in (("data_dir", "data"), ("output_dir", "output"), ("model_dir", "models"))},
        "blocking": {"active_strategies": ["name_prefix", "name_suffix", "address_number", "address_prefix", "rare_numeric_token"], "candidate_cap": 20},
        "models": {"gbt_trees": 3, "gbt_depth": 2, "forest_trees": 5, "forest_depth": 3},
        "training": {"validation_fraction": 0.3, "negative_positive_ratio": 3},
    }))
    return at


def test_train_predict_validate_package(spark, workspace, capsys):
    cfg = load_config(workspace / "c.yaml")
    measured = link.train(spark, cfg)
    assert 0 < measured["macro_f05"] <= 1 and measured["recall_after_cap"] > 0.5
    saved = yaml.safe_load((workspace / "models" / "train_report.yaml").read_text())
    found = saved["blocking"]
    assert {s["strategy_name"] for s in found["strategies"]} <= set(cfg.blocking.active_strategies) and found["large_blocks_skipped"] == 0
    assert all(found["recall_after_cap"][t] <= found["recall_ceiling"][t] <= 1 for t in ("source2", "source3"))
    assert 0.2 <= saved["positive_rate"] <= 1 and sum(saved["importances"].values()) == pytest.approx(1)
    counts = link.predict(spark, cfg)
    assert counts["n_entities"] == 12 and counts["n_matches"] > 0
    out = workspace / "output"
    assert yaml.safe_load((out / "predict_report.yaml").read_text())["n_entities"] == 12
    listed = {(r["source1_entity_id"], r["other_entity_id"]) for r in tsv.read_results(spark, str(out / "matching_results.tsv")).collect()}
    read = lambda name: {line.split("\t")[0]: set(filter(None, line.split("\t")[1].split(","))) for line in (out / name).read_text().splitlines()[1:]}
    matches, candidates = read("matching_results.tsv"), read("candidate_pairs.tsv")
    assert listed == {(k, x) for k, v in matches.items() for x in v}
    assert set(matches) == set(candidates) and all(matches[k] <= candidates[k] for k in matches)
    source1 = str(workspace / "data/test/source1.tsv")
    others = [str(workspace / f"data/test/source{n}.tsv") for n in (2, 3)]
    assert cli.main(["validate", "--output-dir", str(out), "--source1-ids", source1, "--check-ids", *others]) == 0
    assert cli.main(["package", "--output-dir", str(out), "--source1-ids", source1, "--code", str(workspace / "c.yaml"), str(workspace / "data")]) == 0
    names = zipfile.ZipFile(out / "submission.zip").namelist()
    assert {"output/matching_results.tsv", "output/candidate_pairs.tsv", "c.yaml", "data/test/source1.tsv"} <= set(names)
    (out / "matching_results.tsv").write_text("wrong\n")
    assert cli.main(["validate", "--output-dir", str(out), "--source1-ids", source1]) == 1


def test_train_and_predict_with_dense_vectors(spark, workspace):
    """Candidates from precomputed vectors alone: each S1 entity meets the others of its direction and country."""
    cfg = load_config(workspace / "c.yaml")
    cfg.blocking.active_strategies, cfg.blocking.use_dense_embedding = [], True
    cfg.paths.model_dir, cfg.paths.output_dir = f"{workspace}/dense_models", f"{workspace}/dense_output"
    for part, copies in (("train", 6), ("test", 2)):
        rows = [(f"S{n}-{k}{i}", [float(i == j) for j in range(1, 7)]) for n in (1, 2, 3) for k in range(copies) for i in range(1, 7)]
        spark.createDataFrame(rows, "entity_id string, embedding array<double>").write.parquet(f"{workspace}/data/{part}/embeddings.parquet")
    assert link.train(spark, cfg)["recall_after_cap"] == 1
    assert link.predict(spark, cfg)["n_entities"] == 12
    lines = (workspace / "dense_output" / "candidate_pairs.tsv").read_text().splitlines()[1:]
    found = {a: set(filter(None, b.split(","))) for a, b in (line.split("\t") for line in lines)}
    for k in range(2):
        for i in range(1, 6):
            assert found[f"S1-{k}{i}"] == {f"S{n}-{c}{i}" for n in (2, 3) for c in range(2)}
    cfg.paths.embeddings_file = "few.parquet"
    spark.createDataFrame(rows[1:], "entity_id string, embedding array<double>").write.parquet(f"{workspace}/data/test/few.parquet")
    with pytest.raises(ValueError, match="without an embedding: S1-01"):
        link.predict(spark, cfg)


def test_contract(spark):
    q, o = contract.queries(), contract.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 40
    assert contract.entry(spark).columns == ["source1_entity_id", "matched_entity_ids"]


@pytest.mark.parametrize("left", [[], ["corpus_pipeline.py"]])
def test_entry_works_without_the_subpackage(tmp_path, left):
    """A copy of the repository without the training-data operators still imports, with the other queries, whether or not their pipeline is left."""
    import shutil

    root = Path(contract.__file__).resolve().parent
    for name in ("__spark_entry__.py", *left):
        shutil.copy(root / name, tmp_path)
    shutil.copytree(root / "linkloom", tmp_path / "linkloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'block_cap' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_oracles_return_rows():
    """No twin is green because it compares nothing with nothing."""
    import duckdb

    con = duckdb.connect()
    for path in Path("/root/testdata/sf0.001").glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    from linkloom.plans.queries import ORACLES

    for name in ("dense_topk", "unseen_countries", "latin_script", "feat_token_set", "feat_partial", "block_skip_large"):
        assert con.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchone()[0] > 0, name
