from delaycast import session as S


def test_shared_dir_lives_under_the_checkpoint_dir(spark):
    a, b = S.shared_dir(spark, "job"), S.shared_dir(spark, "job")
    base = spark.sparkContext.getCheckpointDir()
    assert base and a.startswith(base.rstrip("/")) and b.startswith(base.rstrip("/"))
    assert a != b                                          # a fresh folder per run


def test_configure_pins_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    S.configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_rocksdb_conf_names_the_provider():
    c = S.rocksdb_state_conf()
    assert c["spark.sql.streaming.stateStore.providerClass"].endswith("RocksDBStateStoreProvider")
