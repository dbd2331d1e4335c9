"""Prompt builders (P1-P4, P6) and small run-log operators."""

from tessera.operators import prompts, runs

OWN = [{"question": "Why is it so?", "steps": ["First this.", "Then that."], "answer": "7"},
       {"question": "And now?", "steps": ["Only this."], "answer": "x y"}]


def test_few_shot_layout(spark):
    df = spark.createDataFrame([("How many?",)], "q string")
    got = df.select(prompts.few_shot_prompt("q", OWN)).first()[0]
    cue = prompts.STEP_CUE
    assert got.split("\n") == [
        "", "Example 1", "Q: Why is it so?", f"A: {cue}", "1. First this.", "2. Then that.", "Answer: 7",
        "", "Example 2", "Q: And now?", f"A: {cue}", "1. Only this.", "Answer: x y",
        "", prompts.FEW_SHOT_TAIL, "Q: How many?", f"A: {cue}", ""]


def test_zero_shot_and_instruction(spark):
    df = spark.createDataFrame([("Add 2 and 3", "", None), ("Sum", "1 2", "x")], "i string, inp string, z string")
    rows = df.select(prompts.instruction_prompt("i", "inp").alias("p"),
                     prompts.instruction_prompt("i", "z").alias("pz"),
                     prompts.zero_shot_prompt("i").alias("zs")).collect()
    assert rows[0]["p"] == "Instruction: Add 2 and 3"
    assert rows[0]["pz"] == "Instruction: Add 2 and 3"
    assert rows[1]["p"] == "Input: 1 2\nInstruction: Sum"
    assert rows[0]["zs"] == "Question: Add 2 and 3\nLet's think step by step."


def test_project_lang_and_label_name(spark):
    df = spark.createDataFrame([({"en": "hi", "cs": "ahoj"}, 1), ({"en": "x"}, 0)],
                               "t map<string,string>, p int")
    rows = df.select(prompts.project_lang("t", "cs").alias("cs"), prompts.label_name("p").alias("n")).collect()
    assert [(r["cs"], r["n"]) for r in rows] == [("ahoj", "Positive"), (None, "Negative")]


def test_save_points_and_total_time(spark):
    log = spark.createDataFrame([(1, e, float(e)) for e in range(1, 8)], "run_id long, epoch int, seconds double")
    sp = {r["epoch"]: r["periodic"] for r in runs.save_points(log, 3).collect()}
    assert [e for e, p in sorted(sp.items()) if p] == [3, 6, 7]
    t = runs.total_time(log).first()
    assert (t["total_seconds"], t["latest_epoch_seconds"], t["epochs"]) == (28.0, 7.0, 7)
    steps = spark.createDataFrame([(1, 1, s) for s in range(1, 21)], "run_id long, epoch int, step int")
    r = runs.step_points(steps, save_steps=10, logging_steps=5).first()
    assert (r["save_points"], r["log_points"]) == (2, 4)


def test_run_compare_pivot(spark):
    per = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 4.0), ("b", 5.0, 6.0)], "fam string, m1 double, m2 double")
    got = {r["metric"]: (r["a"], r["b"], r["c"]) for r in runs.run_compare(per, "fam", ["m1", "m2"], ["a", "b", "c"]).collect()}
    assert got == {"m1": (2.0, 5.0, None), "m2": (3.0, 6.0, None)}


def test_epoch_losses_and_throughput(spark):
    from pyspark.sql import functions as F
    from tessera.operators import clfmetrics as cm
    rows = [(1, 1, m, float(m), t) for m, t in zip(range(1, 6), [2, 0, 1, 1, 4])]
    log = spark.createDataFrame(rows, "run_id long, epoch int, micro int, loss double, tokens int")
    a2 = cm.loss_mean_of_batches(log, batch_size=2).first()
    assert a2["epoch_loss"] == ((1 + 2) / 2 + (3 + 4) / 2 + 5) / 3 and a2["n_batches"] == 3
    a3 = cm.loss_token_weighted(log).first()
    assert a3["epoch_loss"] == (1 * 2 + 3 * 1 + 4 * 1 + 5 * 4) / 8 and a3["tokens"] == 8
    zero = cm.loss_token_weighted(log.withColumn("tokens", F.lit(0))).first()
    assert zero["epoch_loss"] == 0.0  # max(1, tokens) guard
    tps = spark.range(1).select(cm.tokens_per_second(F.lit(10), F.lit(0.0))).first()[0]
    assert tps == 10 / 1e-9
