"""Notices that a bound on the words of a text must not cut."""


from __future__ import annotations

from test_documents import prose

from tierflow.llm import license_scan


def test_every_notice_of_a_text_is_found(spark):
    notices = {t.label: t.text for t in license_scan.TEMPLATES}
    apart = " " + prose(3, 30) + " "
    sets = [
        ["bsd", "apache-2.0"], ["bsd", "gpl-2.0"], ["mit", "apache-2.0"],
        ["bsd", "mit", "gpl-3.0", "apache-2.0", "isc", "mpl-2.0"], sorted(notices),
    ]
    texts = [(k, apart.join(notices[x] for x in labels)) for k, labels in enumerate(sets)]
    found = license_scan.report(spark.createDataFrame(texts, "doc_id long, text string"))
    for row in found.collect():
        assert set(sets[row.doc_id]) == set(row.labels.split(",")) - set(row.base_labels.split(","))

