from cueloom.functions.sql import register


def test_sql_functions(spark):
    register(spark)
    row = spark.sql("SELECT vtt_timestamp(3661.123) a, srt_timestamp(0.2516) b, escape_html('<&') c, norm_edit_distance('lantern', 'pattern') d, word_timing_valid(NULL, 1) e, segment_timing_valid(0, 0) f").first()
    assert tuple(row) == ("01:01:01.123", "00:00:00,252", "&lt;&amp;", 2 / 7, False, False)
    got = [(r.op, r.word) for r in spark.sql("SELECT * FROM diff_words('calm sea', 'calm lake')").collect()]
    assert got == [("keep", "calm"), ("remove", "sea"), ("add", "lake")]
