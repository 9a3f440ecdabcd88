"""License scans score every paragraph, hard-wrapped ones as a whole; pieces of licences count without a telling word."""


def test_pieces_of_wrapped_licences_are_found(spark):
    from volframe.llm.license_scan import fit_licenses, license_scan, paragraphs

    wrapped = "obtaining a copy of this software and associated documentation files,\nto deal in the Software without restriction."
    rows = [(1, wrapped), (2, "a walk to the shop\nyou need a driving license"), (3, "w x y " * 3000), (1, wrapped), (5, wrapped.replace(",\n", ".\n\n").replace("to deal", "To deal")), (4, "as published by the Free Software Foundation")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit_licenses(docs)
    got = {r.doc_id: (r.n_paragraphs, r.n_licensed, r.families) for r in license_scan(docs, model).collect()}
    assert got == {1: (1, 1, ["MIT"]), 2: (1, 0, []), 3: (1, 0, []), 4: (1, 1, ["GPL"]), 5: (3, 2, ["MIT"])}
    assert paragraphs(docs, model).count() == 8  # 1 + 1 + 1 + 1 + 3 + 1
