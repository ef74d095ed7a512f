from tablework.session import MIB, session_settings, shuffle_width, split_bytes

TIB = 1024 * 1024 * MIB


def test_shuffle_width_follows_the_shuffled_bytes():
    assert shuffle_width(8) == 8
    assert shuffle_width(None) == 200
    assert shuffle_width(8, 100 * MIB) == 8
    assert shuffle_width(100, TIB) == 5243
    assert shuffle_width(8000, 100 * TIB) == 524_288
    assert (split_bytes(100 * MIB), split_bytes(100 * TIB)) == (128 * MIB, 512 * MIB)


def test_settings(spark):
    for key, value in session_settings(4).items():
        assert spark.conf.get(key) == value
