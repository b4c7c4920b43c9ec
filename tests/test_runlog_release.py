from convometrics.session import scratch_path
from convometrics.operators import runlog, release

# The published 150-point training loss log (steps 1..150).
LOSS = [
    2.154, 1.993, 2.022, 1.999, 2.059, 1.999, 1.75, 1.779, 1.616, 1.592,
    1.583, 1.466, 1.484, 1.325, 1.242, 1.212, 1.22, 1.084, 1.057, 1.041,
    1.018, 0.9102, 0.8995, 0.9836, 0.9458, 0.9693, 0.9665, 0.9328, 0.858, 0.8086,
    0.7924, 0.8857, 0.8083, 0.8047, 0.8504, 0.7946, 0.853, 0.7414, 0.8879, 0.7552,
    0.7493, 0.7123, 0.776, 0.7094, 0.6734, 0.7879, 0.815, 0.7316, 0.7883, 0.915,
    0.8375, 0.6868, 0.6582, 0.6933, 0.77, 0.8333, 0.746, 0.6856, 0.6507, 0.6546,
    0.6869, 0.6901, 0.64, 0.6681, 0.8434, 0.6541, 0.7577, 0.7198, 0.7264, 0.6272,
    0.6742, 0.8365, 0.6693, 0.6484, 0.6336, 0.5932, 0.6874, 0.6353, 0.786, 0.8596,
    0.5823, 0.5891, 0.7057, 0.6796, 0.6785, 0.7429, 0.6955, 0.589, 0.7011, 0.5688,
    0.6194, 0.7684, 0.8227, 0.6404, 0.6795, 0.799, 0.6922, 0.5898, 0.5569, 0.6509,
    0.5909, 0.646, 0.7615, 0.7199, 0.5729, 0.6753, 0.6189, 0.5495, 0.6599, 0.6658,
    0.6389, 0.6874, 0.5571, 0.6582, 0.8773, 0.6774, 0.7698, 0.7854, 0.6147, 0.6029,
    0.601, 0.5849, 0.5964, 0.5073, 0.665, 0.5905, 0.6543, 0.6016, 0.6652, 0.6313,
    0.555, 0.6285, 0.6918, 0.6687, 0.7426, 0.5656, 0.5869, 0.5454, 0.5791, 0.6571,
    0.5816, 0.5611, 0.6045, 0.5645, 0.5708, 0.6226, 0.5997, 0.68, 0.6114, 0.7095,
]


def test_golden_loss_summary(spark):
    log = spark.createDataFrame([(i + 1, v) for i, v in enumerate(LOSS)], "step int, loss double")
    s = runlog.loss_summary(log.repartition(7)).first()
    assert s.n_steps == 150 and s.initial_loss == 2.154 and s.final_loss == 0.7095
    assert round(s.mean_loss, 4) == 0.8211 and round(s.mean_loss, 6) == 0.821064


def test_published_throughput(spark):
    runs = spark.createDataFrame([("iteration_001", 150, 7328.0, 486)], "run string, steps long, runtime_sec double, n_examples long")
    r = runlog.run_throughput(runs).first()
    assert r.effective_batch == 8 and round(r.samples_per_sec, 3) == 0.164
    assert round(r.sec_per_step, 1) == 48.9 and round(r.epochs, 2) == 2.47


def test_missing_artifacts_and_splits(spark):
    staged = spark.createDataFrame([(1, "train"), (2, "train")], "conv_id long, split string")
    path = scratch_path(spark, "staged")
    release.stage_splits(staged, path)
    miss = {(r.repo, r.artifact) for r in release.missing_artifacts(release.required_artifacts(spark), release.present_artifacts(spark, path)).collect()}
    assert ("dataset", "test.jsonl") in miss and ("dataset", "README.md") in miss and ("dataset", "train.jsonl") not in miss
    assert [r.split for r in release.missing_splits(staged).collect()] == ["test"]
