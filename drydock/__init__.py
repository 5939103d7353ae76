"""drydock - container build-file, image and repository analytics as Spark jobs."""

__version__ = "0.1.0"
