"""Files and tables in, files and tables out."""
