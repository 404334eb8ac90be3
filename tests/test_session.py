from pricekit.session import DEFAULTS, apply_defaults, ensure_checkpoint_dir


def test_defaults_fill_gaps_only(spark):
    key = "spark.sql.adaptive.skewJoin.enabled"
    assert key in DEFAULTS
    spark.conf.set(key, "false")
    try:
        apply_defaults(spark)
        assert spark.conf.get(key) == "false"
    finally:
        spark.conf.set(key, "true")


def test_checkpoint_dir_is_read_from_the_session(spark):
    current = ensure_checkpoint_dir(spark)
    assert current and current == spark.conf.get("spark.checkpoint.dir", None)


def test_library_needs_no_jvm_handle():
    import pathlib

    import pricekit
    for path in pathlib.Path(pricekit.__file__).parent.rglob("*.py"):
        text = path.read_text()
        assert not any(x in text for x in ("_jvm", "_jsc", "sparkContext")), path
