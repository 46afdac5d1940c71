"""The stages that go word by word, as compiled functions of the JVM.

Nested array functions are interpreted node by node, some 25 microseconds a
token. The same rules as plain Java take about one. The source lies in
``tidemark/jvm``; the compiler that Spark itself uses for its generated code
compiles it once per application, and Spark hands the classes to the executors
as a jar. No Python runs in the data path.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.classic.column import _to_java_column, _to_seq

SOURCE = Path(__file__).resolve().parent.parent / "jvm" / "Stages.java"
_loaders: dict = {}


def _loader(spark: SparkSession):
    """The class loader of the compiled stages; the executors get them as a jar."""
    context = spark.sparkContext
    if context.applicationId not in _loaders:
        compiler = context._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(SOURCE.read_text())
        jar = Path(tempfile.mkdtemp()) / "tidemark-stages.jar"
        with zipfile.ZipFile(jar, "w") as out:
            for name, code in dict(compiler.getBytecodes()).items():
                out.writestr(name.replace(".", "/") + ".class", bytes(code))
        context._jsc.addJar(str(jar))
        _loaders.clear()
        _loaders[context.applicationId] = compiler.getClassLoader()
    return _loaders[context.applicationId]


def _array(spark: SparkSession, values: list):
    out = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.Object, len(values))
    for i, value in enumerate(values):
        out[i] = value
    return out


def _static(spark: SparkSession, found, name: str, *args, first: str = ""):
    """A static method by its name and, where there are several, by the type of its first parameter."""
    for method in found.getMethods():
        types = [t.getName() for t in method.getParameterTypes()]
        if method.getName() == name and len(types) == len(args) and types[0].endswith(first):
            return method.invoke(None, _array(spark, list(args)))
    raise AttributeError(name)


def _java(spark: SparkSession, value):
    jvm = spark.sparkContext._jvm
    if isinstance(value, dict):
        out = jvm.java.util.HashMap()
        for k, v in value.items():
            out.put(k, _java(spark, v))
        return out
    if isinstance(value, list | tuple):
        out = jvm.java.util.ArrayList()
        for v in value:
            out.add(_java(spark, v))
        return out
    return value


def shared(table: DataFrame):
    """A table ``(key, value)`` of checked size as a map that each executor holds once."""
    spark = table.sparkSession
    rows = table.select("key", "value")._jdf.collectAsList()
    made = _static(spark, _loader(spark).loadClass("tidemark.Stages"), "table", rows)
    return spark.sparkContext._jsc.broadcast(made)


def function(name: str, kind: str, *args) -> Callable[[Column], Column]:
    """The compiled stage ``name`` as a function of a column that gives ``kind``."""
    spark = SparkSession.active()
    context = spark.sparkContext
    loader = _loader(spark)
    values = _array(spark, [_java(spark, a) for a in args])
    stage = loader.loadClass(f"tidemark.{name}").getConstructors()[0].newInstance(values)
    functions = loader.loadClass("org.apache.spark.sql.functions")
    out = context._jvm.org.apache.spark.sql.types.DataType.fromDDL(kind)
    made = _static(spark, functions, "udf", stage, out, first=".UDF1")
    return lambda column: Column(made.apply(_to_seq(context, [column], _to_java_column)))
