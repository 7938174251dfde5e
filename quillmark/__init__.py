"""Quillmark: integrity, matching and text-witness queries over document corpora, on PySpark."""
