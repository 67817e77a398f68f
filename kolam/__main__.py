import sys

from pyspark.sql import SparkSession

from kolam.cli import main

main(sys.argv[1:], SparkSession.builder.getOrCreate())
