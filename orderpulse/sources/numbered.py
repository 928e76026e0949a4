"""Numbered files, each written once, in a folder of any store that Spark can reach.

Of several writers that want a number at once one gets it. The driver writes them; they are
small and few, such as the manifests of a table or the marks of its writes.
"""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class NumberedFiles:
    """Numbered JSON files in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        conf = spark._jsc.hadoopConfiguration()
        self.name = jvm.org.apache.hadoop.fs.Path
        self.fs = self.name(path).getFileSystem(conf)
        whole = self.fs.makeQualified(self.name(path))
        self.path = str(whole.toString())
        uri = whole.toUri()
        self.local = uri.getPath() if uri.getScheme() == "file" else None
        self.context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, conf)
        self.options = spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 0)
        self.stream = jvm.org.apache.commons.io.IOUtils
        self.charset = jvm.java.nio.charset.StandardCharsets.UTF_8

    def numbers(self) -> list[int]:
        place = self.name(self.path)
        if not self.fs.exists(place):
            return []
        names = (status.getPath().getName() for status in self.fs.listStatus(place))
        return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit())

    def read(self, number: int) -> dict:
        file = self.fs.open(self.name(f"{self.path}/{number:012d}.json"))
        try:
            return json.loads(self.stream.toString(file, self.charset))
        finally:
            file.close()

    def write(self, number: int, content: dict) -> bool:
        """False if the number is taken. The file appears whole, under its name."""
        self.fs.mkdirs(self.name(self.path))
        staged = self.name(f"{self.path}/_{uuid.uuid4().hex}")
        file = self.fs.create(staged, False)
        file.write(bytearray(json.dumps(content).encode()))
        file.close()
        place = f"{self.path}/{number:012d}.json"
        try:
            if self.local is not None:  # a rename within a local folder would replace
                os.link(f"{self.local}/{staged.getName()}", f"{self.local}/{number:012d}.json")
            else:
                self.context.rename(staged, self.name(place), self.options)
        except FileExistsError:
            return False
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception.getClass().getName()):
                raise
            return False
        finally:
            self.fs.delete(staged, False)
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self.name(path), True)

    def take(self, content: dict) -> int:
        """Write the content under the next free number, and tell which it is."""
        numbers = self.numbers()
        number = numbers[-1] + 1 if numbers else 0
        while not self.write(number, content):
            number += 1
        return number
