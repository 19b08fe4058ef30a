"""Training-data operators over the corpus tables (documents, embeddings, pages, labels).

One module per operator; each has a general interface and real outputs. ``queries``
holds the registered queries, which derive their digest columns from those outputs.
Nothing outside this package imports it.
"""
