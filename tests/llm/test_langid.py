import zlib

import odd
from trailseq.llm import langid


def sample(spark, n=300):
    words = {"en": "the and of that with from this have", "fr": "le les des que pour dans avec une",
             "de": "der die das und nicht mit einer von"}
    rows = []
    for i in range(n):
        lang = sorted(words)[i % 3]
        own = words[lang].split()
        rows.append((i, " ".join(own[(i * k) % 8] for k in range(1, 12)), lang))
    return odd.documents(spark, rows)


def test_held_out_accuracy(spark):
    docs = sample(spark)
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 300
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_filter_agrees_with_sets(spark):
    """Bits of the shared filter never miss a member, and false positives stay near their predicted rate."""
    model = langid.train(sample(spark))
    assert model.languages == ["de", "en", "fr"]
    rates, has_letter = model.rates(["the and of that", "", "12"])
    assert rates[0].argmax() == 1 and rates[0, 1] > 0.9 and list(has_letter) == [True, False, False]


def plain_grams(text):
    """4-grams by the definition: lower case, runs of other characters as one space, two spaces before, one behind."""
    flat = "".join(c if c.isalpha() else " " for c in f"  {text.lower()} ")
    body = " ".join(flat.split())
    whole = "  " + (body + " " if body else "")
    return [whole[k:k + 4] for k in range(len(whole) - 3)]


def test_rates_against_exact_sets(spark):
    """Counts of the training texts in plain dictionaries, membership in plain sets."""
    docs = sample(spark)
    model = langid.train(docs, min_share=1e-2)
    counts = {}
    for row in docs.collect():
        own = counts.setdefault(row.lang, {})
        for gram in plain_grams(row.text):
            own[gram] = own.get(gram, 0) + 1
    members = {lang: {g for g, n in own.items() if n >= 1e-2 * sum(own.values())} for lang, own in counts.items()}
    assert any(len(members[lang]) < len(counts[lang]) for lang in counts)  # the share leaves some out
    texts = [r.text for r in docs.collect()[:60]] + ["Über die Brücke, dans la rue of that have", "x", "zzz qqq"]
    rates, _ = model.rates(texts)
    for text, got in zip(texts, rates):
        grams = plain_grams(text)
        for lang, rate in zip(model.languages, got):
            assert abs(rate - sum(g in members[lang] for g in grams) / len(grams)) < 1e-3, (text, lang)


def test_odd_rows(spark):
    model = langid.train(sample(spark).unionByName(odd.documents(spark)))
    rows = langid.predict(odd.documents(spark), model).collect()
    assert len(rows) == len(odd.ROWS)
    by_text = {(r.doc_id, r.text): r for r in rows}
    for key in ((1, None), (2, ""), (3, " \n\t "), (6, "12 .. !!")):
        assert by_text[key].lang_pred == "und" and by_text[key].score == 0.0
    assert by_text[(12, odd.ROWS[14][1])].lang_pred == "de"
    assert by_text[(5, "é")].lang_pred in model.languages
    assert langid.identify(odd.empty(spark)).count() == 0
    untrained = langid.predict(odd.documents(spark), langid.train(odd.empty(spark))).collect()
    assert {r.lang_pred for r in untrained} == {"und"}
