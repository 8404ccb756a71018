"""K2/K4 statements (text only: no database may be started here)."""

from ledgerline.operators.sink import JDBC_COLUMN_TYPES, jdbc_create_table, jdbc_merge


def test_create_table_has_primary_key():
    ddl = jdbc_create_table("posts")
    assert ddl.startswith("CREATE TABLE posts (id VARCHAR(70), post_json CLOB")
    assert ddl.endswith("PRIMARY KEY (id))")


def test_merge_skips_stored_keys_and_is_repeatable():
    sql = jdbc_merge("posts", "posts_stage")
    assert sql.startswith("INSERT INTO posts (" + ", ".join(JDBC_COLUMN_TYPES) + ")")
    assert "WHERE NOT EXISTS (SELECT 1 FROM posts t WHERE t.id = s.id)" in sql

