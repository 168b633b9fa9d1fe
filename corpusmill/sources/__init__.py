"""Reading and writing of files, pages, stores and answer caches."""
