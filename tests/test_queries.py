"""A part of the queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FAST = ["quantity_candidates", "material_best", "line_window_join", "trigger_theta_join", "best_candidate", "token_overlap", "eval_match", "eval_normalize", "eval_normalize_date", "normalize_date", "resolve_source", "split_extra", "group_pages", "pages_to_document_text", "page_confidence", "engine_fallback", "page_error_isolation", "ocr_txt_render", "extraction_json", "pipeline_status", "run_summary", "polygon_bbox", "deskew_angle", "sniff_image_type", "document_reports", "error_messages", "run_summary_document", "exit_status", "latest_run_file", "seed_outcomes", "seed_lookup", "seed_append", "limit_rows", "input_errors", "modality_routing", "page_files", "text_layer_pages", "corner_bbox", "confidence_scale", "round_trip_pages", "round_trip_labels", "stream_summary", "pdf_magic_filter", "generated_forms", "form_outcomes"]


def _plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", FAST)
def test_equals_sql(spark, name):
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    d = entry.queries()[name](spark, SF)
    got = sorted(tuple(_plain(r[k]) for k in sorted(d.columns)) for r in d.collect())
    r = c.execute(entry.oracle_sql()[name])
    at = {x[0]: i for i, x in enumerate(r.description)}
    assert sorted(at) == sorted(d.columns)
    assert got == sorted(tuple(_plain(x[at[k]]) for k in sorted(at)) for x in r.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
