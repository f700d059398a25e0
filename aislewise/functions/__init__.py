"""Column-returning building blocks; nothing here touches a DataFrame or a session."""
