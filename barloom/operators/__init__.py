"""DataFrame -> DataFrame operators; none of them touches a session global."""
