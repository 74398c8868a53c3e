"""Licence notices without a licensing word, and notices wrapped over several lines."""

import random

MIT = ('Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\n'
       "in the Software without restriction, including without limitation the rights")
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"


def test_notices_without_licensing_word_and_wrapped(spark):
    from hirelake.llm.license_scan import scan, train
    single = [("Distributed under the GNU GPL v3.", "GPL-3.0"), ("Creative Commons Attribution 4.0 International (CC BY 4.0)", "CC-BY"),
              ("CC0 1.0 Universal", "CC0"), ("Lizenziert unter CC BY 4.0.", "CC-BY")]
    texts = [t for t, _ in single] + [MIT, BSD, f"x y\n\n \n{MIT}\n\n{BSD}\n", "a\n" * 700 + f"\n{MIT}"]
    out = scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), train(spark)).where("confirmed").collect()
    got = sorted((r.doc_id, r.family, r.paragraph, r.start, r.lines) for r in out)
    assert got == [(i, f, 0, 0, 1) for i, (_, f) in enumerate(single)] + [(4, "MIT", 0, 0, 3), (5, "BSD", 0, 0, 2), (6, "BSD", 7, texts[6].index(BSD), 2),
                                                                       (6, "MIT", 3, 7, 3), (7, "MIT", 701, 1401, 3)]


def test_gate_drops_only_unknown(spark):
    from pyspark.sql import functions as F

    from hirelake.llm.license_scan import OTHERS, TEMPLATES, grams, predicted, tokens, train
    model, rnd = train(spark), random.Random(7)
    known = [w for t in [*OTHERS, *(t for ts in TEMPLATES.values() for t in ts)] for w in t.split()]
    texts = [" ".join(rnd.choices(known, k=rnd.randrange(1, 40))) for _ in range(3000)]
    texts += [" ".join(t.split()[a:b]) for ts in TEMPLATES.values() for t in ts for a in range(4) for b in (2, 4, 6, 9, 99)]
    data = spark.createDataFrame([(t,) for t in sorted(set(texts))], "key string")
    best = predicted(data.select("key", F.explode(grams(tokens(F.col("key")))).alias("gram")), model)
    named = best.where((F.col("family") != "unknown") & (F.col("probability") >= model.least))
    assert named.count() > 100 and named.where(~F.lower("key").rlike(model.gate)).count() == 0
