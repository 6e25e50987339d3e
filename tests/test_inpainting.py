from stridelake.queries import diffusion
from tests.oracle import SF, differences


def test_every_frame_is_sampled(spark):
    name = "df_sampled_inpainting"
    assert differences(spark, diffusion.QUERIES[name], diffusion.ORACLE[name]) == ([], [])
    assert diffusion.QUERIES[name](spark, SF).where("frame >= 10").count() > 0
