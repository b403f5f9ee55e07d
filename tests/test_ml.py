from pyspark.sql import functions as F

from tallyspark.operators import ml


def test_classifier_and_model_interface(spark, tmp_path):
    words = {"AAA": "solar wind turbine power", "BBB": "hog barley dairy farm"}
    rows = [(i, f"{words[c]} number{i % 7} and more text", c) for i in range(120) for c in [("AAA", "BBB")[i % 2]]]
    x = ml.labelled(spark.createDataFrame(rows, "id long, description string, issue_code string"), least=10)
    train, test = ml.split(x)
    assert test.count() == 24 and train.count() == 96
    model = ml.train(train, features=256, iterations=10)
    model.write().overwrite().save(str(tmp_path / "m"))
    out = ml.predict(type(model).load(str(tmp_path / "m")), test).join(test, "id").collect()
    assert sum(r.predicted == r.label for r in out) / len(out) > 0.95 and len(out[0].top) == 2 and out[0].top[0].p >= out[0].top[1].p
    asked = ml.ask_model(test, "id", "text", lambda ps: ["AAA" if "solar" in p else "no such" for p in ps], ["AAA"])
    assert {r.answer for r in asked.collect()} == {"AAA", None}
    assert ml.spend(spark.createDataFrame([(1_000_000, 500_000)], "tokens_in long, tokens_out long"), 2.0, 4.0).first().cost == 4.0


def test_prompts_and_replies(spark):
    texts = spark.createDataFrame([("TAX", "a  long\ntext " + "x" * 900), ("TAX", "other"), ("TAX", " "), ("TRD", None), ("FOO", "food")], "label string, text string")
    got = {r.label: r.prompt for r in ml.phrase_prompt(texts, ["old phrase"], texts=5, chars=20).collect()}
    assert set(got) == {"TAX", "FOO"} and got["TAX"].splitlines()[1:] == ["- a long text xxxxxxxx", "- other"] and "old phrase" in got["FOO"]
    replies = ['```json\n[{"phrase": " Tax  Credit", "label": "TAX"}, {"phrase": "ab", "label": "TAX"}, {"phrase": "no label"}]\n``` as asked', "sorry", None, '[{"phrase": "bad one", "label": "X"}, {"phrase": "tax credit", "label": "TAX"}, {"phrase": "Tax credit", "label": "TAX"}]']
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, r string").select("i", ml.reply_items(F.col("r"), ["bad one"]).alias("x")).orderBy("i").collect()
    assert [[tuple(x) for x in r.x] for r in rows] == [[("tax credit", "TAX")], [], [], [("tax credit", "TAX")]]
