"""Attention.java on the JVM of the driver and the executors: compiled by Janino,
which Spark itself uses for its generated code, and sent to the executors as a jar.
Its vectors need the module ``jdk.incubator.vector``, which Spark's launcher adds.
"""

from __future__ import annotations

import os
import warnings
import zipfile
import zlib

from pyspark.sql import DataFrame, SparkSession

SOURCE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "Attention.java")
CLASS = "staylens.Attention"
_loaders: dict = {}


def loader(spark: SparkSession):
    """The class loader of the compiled source; None where it cannot be had (Spark
    Connect, a JVM without the vectors): the Python code runs then."""
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:  # Spark Connect: no JVM here
        return None
    if key not in _loaders:
        try:
            jvm = sc._jvm
            with open(SOURCE, encoding="utf-8") as f:
                source = f.read()
            compiler = jvm.org.codehaus.janino.SimpleCompiler()
            compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
            compiler.cook(source)
            jar = os.path.join(sc._temp_dir, f"attention-{zlib.crc32(source.encode()):08x}.jar")
            with zipfile.ZipFile(jar, "w") as z:
                for name, code in dict(compiler.getBytecodes()).items():
                    z.writestr(name.replace(".", "/") + ".class", bytes(code))
            found = compiler.getClassLoader()
            found.loadClass(CLASS).getField("LANES").getInt(None)     # fails without the vectors
            sc._jsc.addJar(jar)
            _loaders[key] = found
        except Exception as e:
            warnings.warn(f"Attention.java cannot run, the slower Python code does: {str(e)[:300]}")
            _loaders[key] = None
    return _loaders[key]


def share(spark: SparkSession, data: dict):
    """Broadcast of name -> bytes, for :func:`run`."""
    held = spark.sparkContext._jvm.java.util.HashMap()
    for name, x in data.items():
        held.put(name, bytearray(x if isinstance(x, bytes) else x.tobytes()))
    return spark.sparkContext._jsc.broadcast(held)


def run(df: DataFrame, job: str, shared, schema: str) -> DataFrame:
    """The rows that the class makes of each partition of ``df``."""
    spark = df.sparkSession
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    args = gateway.new_array(jvm.java.lang.Object, 2)
    args[0], args[1] = job, shared
    function = loader(spark).loadClass(CLASS).getConstructors()[0].newInstance(args)
    encoder = jvm.org.apache.spark.sql.Encoders.row(jvm.org.apache.spark.sql.types.StructType.fromDDL(schema))
    return DataFrame(df._jdf.mapPartitions(function, encoder), spark)
