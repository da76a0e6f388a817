"""Writers: files, JDBC tables, message topics, previews."""
