"""One limit for all tasks and harvests of an application: a small server on the driver says when a request may go.

A client names the service and gets back how long it has to wait; the server only keeps the next free time of each
service. Whoever asks next gets the next slot, so that what an idle task doesn't use goes to the busy ones, and two
harvests at once share one limit. A slot whose client is lost is lost; nothing waits for it.
"""

from __future__ import annotations

import hmac
import json
import secrets
import socket
import socketserver
import threading
import time
from typing import NamedTuple

from pyspark.sql import SparkSession


class Address(NamedTuple):
    """Where the server is and what proves that a client belongs to the application; travels to the tasks."""

    host: str
    port: int
    token: str


class Leases:
    """The server of an application. Start it with of(); clients are Lease objects."""

    def __init__(self, host: str, safety: float = 0.9, clock=time.monotonic):
        self.safety, self.clock, self.lock = safety, clock, threading.Lock()
        self.free: dict[str, float] = {}
        token = secrets.token_hex(16)
        leases = self

        class Handler(socketserver.StreamRequestHandler):
            timeout = 30

            def handle(self) -> None:
                asked = json.loads(self.rfile.readline(10_000))
                if hmac.compare_digest(asked["token"], token):
                    self.wfile.write(f"{leases.slot(asked['service'], asked['per_minute'])}\n".encode())

        self.server = socketserver.ThreadingTCPServer((host, 0), Handler)
        self.server.daemon_threads = True
        self.address = Address(host, self.server.server_address[1], token)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def slot(self, service: str, per_minute: float) -> float:
        """Seconds until the next request to the service may go; the slot is taken."""
        with self.lock:
            now = self.clock()
            at = max(now, self.free.get(service, now))
            self.free[service] = at + 60 / (per_minute * self.safety)
            return at - now

    def close(self) -> None:
        self.server.shutdown()
        self.server.server_close()

    @staticmethod
    def of(spark: SparkSession) -> Leases:
        """The application's server; started at the first call, on the address by which executors reach the driver."""
        sc = spark.sparkContext
        found = getattr(sc, "_cairn_leases", None)
        if found is None:
            found = sc._cairn_leases = Leases(sc.getConf().get("spark.driver.host", "127.0.0.1"))
        return found


class Lease:
    """A client's side: wait() returns when the next request to the service may go."""

    def __init__(self, address: Address, service: str, per_minute: float):
        self.address, self.asked = address, json.dumps({"token": address.token, "service": service, "per_minute": per_minute}).encode() + b"\n"

    def wait(self) -> None:
        with socket.create_connection(self.address[:2], timeout=30) as s:
            s.sendall(self.asked)
            reply = s.makefile("rb").readline()
        if not reply:
            raise RuntimeError("the limit's server refused the request")
        time.sleep(float(reply))
