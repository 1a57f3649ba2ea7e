"""Days written as text."""

import datetime as dt

from quern.operators import cleaning


def test_text_days_of_many_formats(spark):
    texts = ["2013-04-09", " April 9, 2013", "Apr 9, 2013", "4/9/2013", "9-Apr-2013", "2013-04-09 10:11:12", "someday", "", None, "13/45/2013"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, sold on string".replace("sold on", "`sold on`"))
    found = cleaning.to_date_column(df, "sold on", "day", failed="unread").orderBy("i").collect()
    assert [r.day for r in found] == [dt.date(2013, 4, 9)] * 6 + [None] * 4
    assert [r.unread for r in found] == [False] * 6 + [True, True, False, True]
    only = cleaning.to_date_column(df, "sold on", "day", formats=()).where("day IS NOT NULL")
    assert only.count() == 2
