"""The queries of this subpackage and, where SQL can express them, the same in SQL."""

from axisforge.llm import ann, bpe, exact, language, mixing, near, quality, sharding, suffix, urls
from axisforge.llm.common import ship


def _query(f):
    def run(spark, sf_dir):
        ship(spark)
        return f(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _query(f)
    for f in (
        sharding.op1_lpt_shards,
        suffix.op2_suffix_lpf_dedup,
        mixing.op3_water_fill_mix,
        ann.op4_inverted_multi_index,
        bpe.op5_prefix_bpe,
        urls.op6_redirect_url_filter,
        language.op7_fused_language_id,
        exact.op8_content_sort_dedup,
        quality.op9_kneser_ney_quality,
        near.op10_icws_near_dedup,
    )
}
SQL = {
    "op1_lpt_shards": sharding.OP1_SQL,
    "op3_water_fill_mix": mixing.OP3_SQL,
    "op6_redirect_url_filter": urls.OP6_SQL,
    "op8_content_sort_dedup": exact.OP8_SQL,
}
